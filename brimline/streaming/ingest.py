"""Structured Streaming forms of the file ingest and of the regular panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from brimline.operators.dedup import keep_last
from brimline.schema import PANEL_COLUMNS, RAW_TO_PANEL, SITE, TIME, TIMEZONE
from brimline.sources.crawl import headers_of, names_of, rejects_of, typed_lines, with_places


def stream_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of a landing folder as they come, with their file, the block they stand in, and
    when the file came. Large files are read by many tasks."""
    files = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files).text(path)
    )
    return files.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_modification_time").alias("arrival"),
    )


def parsed_batch(batch: DataFrame, tz: str = TIMEZONE, label_local_as_utc: bool = False, **options) -> DataFrame:
    """Typed panel rows of one batch of :func:`stream_lines`, each with ``reject_reason`` (NULL
    when good). A file is whole in its batch, so its lines are read by its own header and
    numbered in order, as in :func:`brimline.sources.crawl.parse_lines`."""
    lines = batch.withColumn("_line_no", F.monotonically_increasing_id())
    headers = with_places(headers_of(lines)).drop("_names")
    rows = lines.join(headers, "_path").filter(F.col("line") != F.col("_header"))
    return typed_lines(rows, tz, label_local_as_utc, keep=["arrival"], **options)


def ingest_stream(
    spark: SparkSession, path: str, out: str, checkpoint: str, rejects: str | None = None,
    tz: str = TIMEZONE, label_local_as_utc: bool = False, max_files: int = 1000, **options,
) -> DataStreamWriter:
    """Writer that turns a landing folder into panel updates, read with :func:`read_updates`.

    Of repeated rows the last line of the last file wins, files in order of their time, then
    path: inside a batch here, over batches when they are read. Each batch has a folder of its
    own, which a repeated batch overwrites, so no state grows and a restart does no harm. Lines
    that are not observations go to ``rejects`` in the same way.
    """
    order = ["arrival", "_path", "_block", "_line_no"]

    def save(batch: DataFrame, batch_id: int) -> None:
        parsed = parsed_batch(batch, tz, label_local_as_utc, **options)
        good = parsed.filter(F.col("reject_reason").isNull() & F.col(SITE).isNotNull())
        rows = keep_last(good.select(*PANEL_COLUMNS, *order), [SITE, TIME], order, drop=order)
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if rejects:
            rejects_of(parsed).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    lines = stream_lines(spark, path, max_files)
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)


def stream_parsed(
    spark: SparkSession, path: str, tz: str = TIMEZONE, label_local_as_utc: bool = False,
    max_files: int = 1000, **options,
) -> DataFrame:
    """Typed panel rows from a landing folder, each with ``reject_reason`` (NULL when good),
    its ``line`` and ``arrival``, which orders files by modification time, then path.

    For landing files that fit a task: a file comes as one value, so that its own header reads
    its lines inside the stream. Larger ones, or ones with repeats, are for :func:`ingest_stream`.
    """
    files = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files).text(path, wholetext=True)
    )
    lines = files.select(
        F.col("_metadata.file_path").alias("_path"), F.lit(0).cast("bigint").alias("_block"),
        F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("arrival"),
        F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "").alias("_all"),
    )
    lines = lines.withColumn("_header", F.get("_all", F.lit(0))).withColumn("_names", names_of(F.col("_header"), RAW_TO_PANEL))
    lines = with_places(lines).drop("_names")
    each = lines.select("*", F.posexplode("_all").alias("_line_no", "line")).filter(F.col("line") != F.col("_header"))
    return typed_lines(each, tz, label_local_as_utc, keep=["arrival"], **options)


def stream_records(spark: SparkSession, path: str, tz: str = TIMEZONE, label_local_as_utc: bool = False, max_files: int = 1000) -> DataFrame:
    """The good rows of :func:`stream_parsed` with a site, as panel columns and ``arrival``."""
    parsed = stream_parsed(spark, path, tz, label_local_as_utc, max_files)
    good = F.col("reject_reason").isNull() & F.col(SITE).isNotNull()
    return parsed.filter(good).select(*PANEL_COLUMNS, "arrival")


def stream_rejects(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of the landing folder that are not observations: ``reject_reason, line, path``."""
    parsed = stream_parsed(spark, path, **options)
    return parsed.filter(F.col("reject_reason").isNotNull()).select("reject_reason", "line", F.col("_path").alias("path"))


def latest_per_key(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """The last arrived row per site and time, corrected when a later file repeats it.

    Run in update mode. State is dropped, and later repeats are ignored, once the
    watermark is ``delay`` past a time. ``arrival`` must order the rows; of equal ones the
    greater row is taken, so that the choice does not change between runs. Files with repeats
    inside are for :func:`ingest_stream`, which knows the order of their lines.
    """
    rest = [c for c in PANEL_COLUMNS if c not in (SITE, TIME)]
    row = F.struct(*rest)
    return (
        stream.withWatermark(TIME, delay)
        .groupBy(SITE, TIME)
        .agg(F.max_by(row, F.struct("arrival", row)).alias("_r"))
        .select(SITE, TIME, *[F.col(f"_r.{c}").alias(c) for c in rest])
    )


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that keeps every update under ``batch_id=N``; a repeated batch overwrites its
    own folder, so a restart does no harm. Read it back with :func:`read_updates`."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """The panel a stream of updates stands for: the newest batch per key."""
    updates = spark.read.option("basePath", path).parquet(path)
    return keep_last(updates, [SITE, TIME], ["batch_id"], drop=["batch_id"])


def hourly_stream(
    events: DataFrame, site: str, time: str, value: str, width: str = "1 hour", delay: str = "2 hours"
) -> DataFrame:
    """Mean of ``value`` per site and tumbling window; rows later than ``delay`` behind the
    newest are dropped. In append mode a window comes out once it is complete, and the last ones
    when later events come; in update mode (:func:`write_updates`) all are there at once."""
    panes = events.withWatermark(time, delay).groupBy(F.col(site), F.window(time, width))
    return panes.agg(F.avg(value).alias("y"), F.count(F.lit(1)).alias("n")).select(
        site, F.col("window.start").alias(TIME), "y", "n"
    )
