"""Which polls of a schedule are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.functions.time import step_micros


def expected_polls(spark: SparkSession, start: str, end: str, step: str | int = "1H") -> DataFrame:
    """Poll times from ``start`` to ``end`` inclusive, made by distributed ranges."""
    width = step_micros(step)
    bounds = spark.range(1).select(
        F.unix_micros(F.lit(start).cast("timestamp")).alias("lo"),
        F.unix_micros(F.lit(end).cast("timestamp")).alias("hi"),
    ).first()  # two literals
    if bounds.hi < bounds.lo:
        raise ValueError("schedule ends before it starts")
    polls = spark.range((bounds.hi - bounds.lo) // width + 1)
    return polls.select(F.timestamp_micros(F.lit(bounds.lo) + F.col("id") * F.lit(width)).alias("poll_time"))


def missing_polls(expected: DataFrame, received: DataFrame, poll_time: str = "poll_time") -> DataFrame:
    """Expected polls that were not received."""
    return expected.join(received.select(poll_time).distinct(), poll_time, "left_anti")


def coverage_by_month(expected: DataFrame, received: DataFrame, poll_time: str = "poll_time") -> DataFrame:
    """Expected, received and missing polls per month."""
    got = received.select(poll_time).distinct().withColumn("_got", F.lit(1))
    marked = expected.join(got, poll_time, "left")
    return (
        marked.groupBy(F.date_format(poll_time, "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("expected"), F.count("_got").alias("received"))
        .withColumn("missing", F.col("expected") - F.col("received"))
    )
