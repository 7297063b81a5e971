from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from brimline.schema import RAW_COLUMNS
from brimline.streaming.ingest import (
    hourly_stream,
    ingest_stream,
    latest_per_key,
    read_updates,
    stream_records,
    write_updates,
)
from brimline.sources.crawl import read_crawl
from brimline.sources import sinks

HEADER = ",".join(RAW_COLUMNS)


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_later_file_wins_across_restarts(spark, tmp_path):
    landing = tmp_path / "in" / "month=2024-01"
    landing.mkdir(parents=True)

    def poll():
        rows = latest_per_key(stream_records(spark, str(tmp_path / "in"), label_local_as_utc=True), "7 days")
        drain(write_updates(rows, str(tmp_path / "out"), str(tmp_path / "state")))

    def land(name, *lines):
        (landing / name).write_text("\n".join([HEADER, *lines]) + "\n")

    land("part-0.csv", "A,01/01 00:00,1", "A,01/01 01:00,2", "A,bad,3")
    poll()
    land("part-1.csv", "A,01/01 00:00,10", "B,20/01 00:00,5")
    poll()
    land("part-2.csv", "A,01/01 01:00,99", "B,20/01 00:00,6")  # the first is behind the watermark
    poll()
    got = read_updates(spark, str(tmp_path / "out")).collect()
    assert {(r.site_id, str(r.timestamp), r.muc_thuong_luu) for r in got} == {
        ("A", "2024-01-01 00:00:00", 10.0), ("A", "2024-01-01 01:00:00", 2.0), ("B", "2024-01-20 00:00:00", 6.0)}


def test_stream_equals_batch_line_by_line(spark, tmp_path):
    landing = tmp_path / "in" / "month=2024-01"
    landing.mkdir(parents=True)
    out = str(tmp_path / "out")

    def poll():
        drain(ingest_stream(spark, str(tmp_path / "in"), out, str(tmp_path / "state"), str(tmp_path / "bad"), label_local_as_utc=True))

    # repeats inside a file, the lesser last; its own column order; a file cut over many tasks
    (landing / "part-0.csv").write_text(HEADER + "\nA,01/01 00:00,9\nA,01/01 00:00,5\nA,31/02 00:00,1\n")
    (landing / "part-1.csv").write_text("muc_nuoc_thuong_luu,timestamp,ten_ho\n7,01/01 01:00,A\n\n8,01/01 01:00,A,1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        many = [f"B,{d:02d}/01 {h:02d}:00,{k}" for k in range(2) for d in range(1, 20) for h in range(24)]
        (landing / "part-2.csv").write_text(HEADER + "\n" + "\n".join(many) + "\n")
        poll()
        batch = read_crawl(spark, str(tmp_path / "in"), label_local_as_utc=True)
        rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        assert rows(read_updates(spark, out)) == rows(batch) and batch.count() == 2 + 19 * 24
        assert {(r.site_id, r.muc_thuong_luu) for r in batch.collect()} == {("A", 5.0), ("A", 7.0), ("B", 1.0)}
        (landing / "part-3.csv").write_text(HEADER + "\nA,01/01 00:00,2\n")
        poll()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(r.site_id, r.muc_thuong_luu) for r in read_updates(spark, out).filter("site_id = 'A'").collect()}
    assert got == {("A", 2.0), ("A", 7.0)}
    assert sorted(r.reject_reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["bad timestamp", "too many fields"]


def test_repeated_append_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i}", "01/01 00:00", float(i), datetime(2024, 1 + i % 2, 1)) for i in range(6)],
                                 "ten_ho string, timestamp string, muc_nuoc_thuong_luu double, poll_time timestamp")
    rows = rows.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in RAW_COLUMNS if c not in rows.columns])
    polls = spark.createDataFrame([(i, datetime(2024, 1, 1 + i), 500, "p", "x" * 6000 if i else "a\nb") for i in range(3)],
                                  "page_id long, poll_time timestamp, status_code int, params string, content string")
    records, failures = str(tmp_path / "r"), str(tmp_path / "f")
    for batch_id, some in (("001", rows.filter("muc_nuoc_thuong_luu < 4")), ("001", rows.filter("muc_nuoc_thuong_luu < 3")), ("002", rows)):
        sinks.append_polls(polls, some.withColumn("page_id", F.lit(0)), records, failures, batch_id)
    got = spark.read.option("header", True).csv(f"{records}/batch=*/month=*")
    assert got.count() == 3 + 6
    failed = spark.read.option("header", True).csv(f"{failures}/batch=*/month=*")
    assert failed.count() == 2 * 2 and {len(r.content) for r in failed.collect()} == {5001}
    assert read_crawl(spark, records).count() == 6
    import pytest

    with pytest.raises(ValueError):
        sinks.append_records(rows, records, batch_id="../x")


def test_hourly_windows_close_after_the_delay(spark, tmp_path):
    ts = pd.to_datetime(["2024-01-01 00:10", "2024-01-01 00:50", "2024-01-01 01:30", "2024-01-01 05:00"])
    rows = spark.createDataFrame(pd.DataFrame({"site": "a", "ts": ts, "v": [1.0, 3.0, 5.0, 7.0]}))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = hourly_stream(stream, "site", "ts", "v")
    drain(out.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
          .option("checkpointLocation", str(tmp_path / "state")))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp").collect()
    assert [(r.timestamp.hour, r.y, r.n) for r in got] == [(0, 2.0, 2), (1, 5.0, 1)]
    assert spark.read.parquet(str(tmp_path / "in")).agg(F.max("v")).first()[0] == 7.0
