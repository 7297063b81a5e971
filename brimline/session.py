"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are stored as UTC; local calendars come from explicit zone names."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where that is unset, a folder beside the tables of the warehouse serves a session whose
    tasks run in the driver; on a cluster the folder must be named.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"name a folder that all executors reach in {CHECKPOINT_KEY}")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that later steps that need
    them more than once, or a lost executor, do not start from the sources again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
