"""Line parser, headers per file, streams by name, and other corrections."""

import os

import pytest
from pyspark.sql import functions as F

from brimline.functions.text import looks_like_data, normalize_text, number
from brimline.operators.evaluate import metrics, nested_metrics
from brimline.operators.windows import has_gaps
from brimline.schema import RAW_COLUMNS
from brimline.sources import crawl
from brimline.sources.sinks import write_metrics
from brimline.streaming.ingest import stream_records, stream_rejects


def fields(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    return [r.f for r in df.select("i", crawl._fields(F.col("line")).alias("f")).orderBy("i").collect()]


def test_fields_of_a_line(spark):
    long = "x" * 5_001
    longer = ",".join(["yy"] * 60_000)
    pairs = '""' * 100_000
    got = fields(spark, [
        "a,b,c", ",x,y", "a,,c,", '"a,b",c', 'a,"b ""q"" c",d', '"{""a"":1,""b"":2}",z', f'{long},"{long}"',
        f'1,"{longer}",2', f'"{pairs}",2', '"""a"",b",c', '5" pipe,x', 'a,"open, rest', '""', '"",x',
    ])
    assert got == [
        ["a", "b", "c"], [None, "x", "y"], ["a", None, "c", None], ["a,b", "c"], ["a", 'b "q" c', "d"],
        ['{"a":1,"b":2}', "z"], [long, long], ["1", longer, "2"], ['"' * 100_000, "2"], ['"a",b', "c"],
        ['5" pipe', "x"], ["a", '"open, rest'], [None], [None, "x"],
    ]


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_reference_like_files_with_long_fields(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    content = "<td>" + "z" * 5_000
    put(tmp_path, "2020-01.csv", "\n".join([
        "", "  ", header, "S1,01/01 00:00,1,2,3,4,5,6,7,8,9",
        f"2020-01-01 00:00,500,\"{crawl.FAILURE_MARK}}}\",\"{content}\"", f"2020-01-01 01:00,500,x,{content}",
        ",01/01 02:00,1", 'S1,01/01 03:00,"2,5",2',
    ]))
    parsed = crawl.parse_lines(crawl.read_lines(spark, str(tmp_path)))
    good = sorted(crawl.panel_of(parsed).collect(), key=lambda r: r.timestamp)
    assert [(r.site_id, r.muc_thuong_luu) for r in good] == [("S1", 1.0), (None, 1.0), ("S1", None)]
    why = {r.reject_reason for r in crawl.rejects_of(parsed).collect()}
    assert why == {"failure row", "bad timestamp"}
    with pytest.raises(FileNotFoundError):
        put(tmp_path / "none", "a.txt", "x")
        crawl.read_lines(spark, str(tmp_path / "none"))


def test_panel_files_by_their_own_header(spark, tmp_path):
    put(tmp_path, "a.csv", "timestamp,site_id,muc_thuong_luu,luu_luong_den\n2024-01-01 00:00:00,A,2,200\n")
    put(tmp_path, "b.csv", "luu_luong_den,timestamp,muc_thuong_luu,note\n201,2024-01-01 01:00:00,3,hello\n")
    rows = sorted(crawl.read_panel(spark, str(tmp_path)).collect(), key=lambda r: r.timestamp)
    assert [(r.site_id, r.muc_thuong_luu, r.luu_luong_den, r.note) for r in rows] == [
        ("A", 2.0, 200.0, None), ("SITE_001", 3.0, 201.0, "hello")]
    put(tmp_path / "bad", "c.csv", "site_id\nA\n")
    with pytest.raises(Exception, match="timestamp"):
        crawl.read_panel(spark, str(tmp_path / "bad"))


def test_stream_by_name_with_rejects(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "2020-01.csv", "ten_ho,timestamp,muc_nuoc_thuong_luu,luu_luong_den_ho\nS1,01/01 00:00,2,500\nS1,99/01 00:00,2,5\n")
    put(src, "2020-02.csv", "luu_luong_den_ho,ten_ho,muc_nuoc_thuong_luu,timestamp\n501,S1,3,01/02 00:00\n")
    put(src, "undated.csv", "ten_ho,timestamp\nS9,01/01 00:00\n")
    out = {}
    for name, stream in (("good", stream_records(spark, str(src))), ("bad", stream_rejects(spark, str(src)))):
        q = stream.writeStream.format("memory").queryName(f"by_name_{name}").outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        out[name] = spark.table(f"by_name_{name}").collect()
    assert sorted((r.site_id, r.muc_thuong_luu, r.luu_luong_den) for r in out["good"]) == [("S1", 2.0, 500.0), ("S1", 3.0, 501.0)]
    assert sorted(r.reject_reason for r in out["bad"]) == ["bad timestamp", "no year in file name"]


def test_gaps_do_not_depend_on_chunks(spark):
    at = [0, 1, 2, 40, 41, 900, 4000, 4001, 9000]
    df = spark.createDataFrame([("a", i, i) for i in at] + [("b", 5, 5), ("b", 6, 6)], "site_id string, time_idx bigint, v bigint")
    want = [(40, 37), (900, 858), (4000, 3099), (9000, 4998)]
    for steps in (5, 50, 1000, 3840):
        assert sorted((r.time_idx, r.gap_before) for r in has_gaps(df, chunk_steps=steps).collect()) == want


def test_texts(spark):
    df = spark.createDataFrame([("\U0001d400\U0001d401 Việt",), ("한글 각",), ("\t12.5\n",)], "t string")
    import unicodedata

    got = [r.n for r in df.select(normalize_text(F.col("t")).alias("n")).collect()]
    assert got[0] == "ab viet"
    assert got[1] == unicodedata.normalize("NFKD", "한글 각")
    assert [r.x for r in df.select(number(F.col("t")).alias("x")).collect()] == [None, None, 12.5]
    cells = spark.createDataFrame([(["nan", "NaN", "x"],), (["a", "1"],)], "c array<string>")
    assert [r.d for r in cells.select(looks_like_data(F.col("c"), 3).alias("d")).collect()] == [True, False]


def test_metrics_with_a_missing_step_and_own_horizons(spark, tmp_path):
    rows = [("a", 0, s, 1.0 if s > 1 else None, 0.0, 1.0, 2.0) for s in (1, 2, 3)] + [("a", 1, 1, 2.0, 0.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "site_id string, origin_idx bigint, step int, y double, q10 double, q50 double, q90 double")
    row = metrics(df, horizons={"2h": 2})
    assert row.first().n_samples == 2
    assert set(nested_metrics(row).first().horizon_wise.asDict()) == {"MAE_2h", "RMSE_2h"}
    write_metrics(row, str(tmp_path / "m"))
