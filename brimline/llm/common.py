"""What several operators share: reading tables, text as arrays, settled scratch tables."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.session import scratch_path, use_utc

#: Fixed value: what separates words, as the inside of a character class.
BLANKS = r"\x20\x09-\x0D"
BLANK_CHARS = " \t\n\x0b\x0c\r"


#: Bytes handed to Python at once; long texts then come in small batches.
BATCH_BYTES = 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """What the operators rely on: UTC, bounded batches for Python, and workers that find this
    package where the driver has it (a cluster without that folder has it installed)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return use_utc(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: str | Column = "text") -> Column:
    """A text, NULL taken as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: runs of anything but space and the five control blanks."""
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage so that a lost executor costs one step, and keeps work that several
    later steps read from being done again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, though used often, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_place(condition: Column) -> Column:
    """A condition that Spark works out where it stands. Else a filter on it moves below the
    columns it is made of, which puts their expressions into each other."""
    return condition & (F.monotonically_increasing_id() >= 0)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
