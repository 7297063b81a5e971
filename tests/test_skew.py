"""A series that holds most of the rows must not end up in one task."""

import pandas as pd
from pyspark.sql import functions as F

from brimline.operators.features import add_position
from brimline.operators.grid import regularize_chunks
from brimline.operators.windows import normalize_target
from brimline.plans.chunks import CHUNK, with_halo


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def hot(spark, hours=40_000):
    t = pd.date_range("2015-01-01", periods=hours, freq="h")
    pdf = pd.concat([pd.DataFrame({"site_id": "hot", "timestamp": t, "y": 1.0 * (t.hour == 3)}),
                     *[pd.DataFrame({"site_id": f"s{i}", "timestamp": t[:50], "y": 2.0}) for i in range(20)]])
    return spark.createDataFrame(pdf)


def test_long_series_is_spread(spark):
    chunked = regularize_chunks(hot(spark), chunk_steps=1000, halo=24)
    assert largest_share(chunked) < 0.35
    rows = chunked.filter(~F.col("_halo")).drop(CHUNK, "_halo")
    assert largest_share(with_halo(rows, "site_id", "time_idx", back=5, chunk_steps=1000)) < 0.35
    assert largest_share(normalize_target(rows, "y", chunk_steps=1000)) < 0.35


def test_chunk_rows_are_bounded(spark):
    chunked = regularize_chunks(hot(spark), chunk_steps=1000, halo=24)
    assert chunked.groupBy("site_id", CHUNK).count().agg(F.max("count")).first()[0] == 1024


def test_one_busy_hour_is_ranked_by_many_tasks(spark):
    at = pd.to_datetime("2024-01-01") + pd.to_timedelta([i // 40 for i in range(30_000)], unit="s")  # 40 rows a second
    pdf = pd.concat([pd.DataFrame({"site_id": "hot", "timestamp": at, "y": range(30_000)}),
                     *[pd.DataFrame({"site_id": f"s{i}", "timestamp": at[:30], "y": -1}) for i in range(40)]])
    out = add_position(spark.createDataFrame(pdf).repartition(5), whole=1000)
    assert largest_share(out) < 0.35
    got = out.toPandas().sort_values(["site_id", "time_idx"])
    for _, g in got.groupby("site_id"):
        assert (g.time_idx.to_numpy() == range(len(g))).all() and (g.series_len == len(g)).all()
        assert g.timestamp.is_monotonic_increasing
    assert sorted(got.y) == sorted(pdf.y)


def test_one_instant_holds_a_series(spark):
    pdf = pd.DataFrame({"site_id": None, "timestamp": pd.to_datetime("2024-01-01"), "y": range(8000)})
    out = add_position(spark.createDataFrame(pdf, "site_id string, timestamp timestamp, y long"), whole=100)
    assert largest_share(out) < 0.6 and sorted(r.time_idx for r in out.collect()) == list(range(8000))
