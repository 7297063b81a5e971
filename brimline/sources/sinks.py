"""Writers. All write from the executors; ordered output is range-partitioned, not
collected into one task."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.operators.dedup import sorted_by_series
from brimline.operators.evaluate import nested_metrics
from brimline.operators.split import SPLIT, apply_scalers, fit_scalers
from brimline.schema import RAW_COLUMNS, SITE, TIME, feature_manifest, require

CONTENT_LIMIT = 5000


def iso_utc(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` (session time zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_canonical_csv(panel: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Panel as CSV ordered by site and time."""
    ordered = sorted_by_series(panel)
    ordered.withColumn(TIME, iso_utc(F.col(TIME))).write.mode(mode).option("header", True).csv(path)
    return path


def write_splits(
    df: DataFrame, path: str, fmt: str = "parquet", scaled: bool = False, mode: str = "errorifexists"
) -> dict[str, str]:
    """Featured rows partitioned by ``split``; with ``scaled`` also a standardised copy and
    the statistics it was made with.

    The raw table is written first and read back, so scaling starts from the files and not
    from another run of the preparation.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format: {fmt!r}")
    require(df, SPLIT)
    spark = df.sparkSession

    def write(frame: DataFrame, to: str) -> None:
        if fmt == "csv":
            frame = frame.withColumn(TIME, iso_utc(F.col(TIME)))
        writer = frame.write.mode(mode).partitionBy(SPLIT)
        writer.option("header", True).csv(to) if fmt == "csv" else writer.parquet(to)

    out = {"raw": f"{path}/raw"}
    write(df, out["raw"])
    if scaled:
        rows = spark.read.schema(df.schema).option("header", True).format(fmt).load(out["raw"])
        out |= {"scalers": f"{path}/scalers", "scaled": f"{path}/scaled"}
        train = rows.filter(F.col(SPLIT) == "train")  # prunes to one partition
        fit_scalers(train).write.mode(mode).parquet(out["scalers"])
        write(apply_scalers(rows, spark.read.parquet(out["scalers"])), out["scaled"])
    return out


def forecast_table(forecast: DataFrame, site: str | None = SITE, time: str = TIME) -> DataFrame:
    """Forecast rows under the output names."""
    keys = [site] if site and site in forecast.columns else []
    actual = F.col("y") if "y" in forecast.columns else F.lit(None).cast("double")
    return forecast.select(
        *keys, time,
        F.col("q10").alias("predicted_q10"),
        F.col("q50").alias("predicted_median"),
        F.col("q90").alias("predicted_q90"),
        actual.alias("actual_value"),
    )


def write_forecast(forecast: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> str:
    table = forecast_table(forecast)
    if fmt == "csv":
        table = table.withColumn(TIME, iso_utc(F.col(TIME)))
    writer = table.write.mode(mode)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)
    return path


def metrics_json(row: DataFrame) -> DataFrame:
    """The metrics row as one JSON document per row."""
    nested = nested_metrics(row)
    return nested.select(F.to_json(F.struct(*nested.columns)).alias("value"))


def metrics_text(row: DataFrame) -> DataFrame:
    """The metrics row as text lines ``group, name, value`` with four decimals."""
    nested = nested_metrics(row)
    groups = [g for g in nested.columns if g != "metadata"]
    titles = {"overall": "Overall Performance", "horizon_wise": "Horizon-wise Performance",
              "quantile_loss": "Quantile Loss"}
    lines = []
    for g in groups:
        lines.append(F.lit(f"{titles[g]}:"))
        for name in nested.schema[g].dataType.names:
            value = F.replace(F.format_number(F.col(g)[name], 4), F.lit(","), F.lit(""))
            lines.append(F.concat(F.lit(f"  {name}: "), value))
    return nested.select(F.posexplode(F.array(*lines)).alias("line_no", "value"))


def write_metrics(row: DataFrame, path: str, mode: str = "errorifexists") -> dict[str, str]:
    """``{path}/json`` and ``{path}/text``; one row, so one small file each."""
    out = {"json": f"{path}/json", "text": f"{path}/text"}
    metrics_json(row).write.mode(mode).text(out["json"])
    metrics_text(row).orderBy("line_no").select("value").coalesce(1).write.mode(mode).text(out["text"])
    return out


def manifest_frame(df: DataFrame, **options) -> DataFrame:
    """The feature manifest as a one-row frame, from the schema alone."""
    manifest = feature_manifest(df, **options)
    spark: SparkSession = df.sparkSession
    features = manifest.pop("features")
    return spark.range(1).select(
        *[F.array(*map(F.lit, v)).alias(k) if isinstance(v, list) else F.lit(v).alias(k) for k, v in manifest.items()],
        F.struct(
            *[F.array(*map(F.lit, v)).cast("array<string>").alias(k) for k, v in features.items()]
        ).alias("features"),
    )


def write_manifest(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> str:
    manifest_frame(df, **options).write.mode(mode).json(path)
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as written, one row; a part left out of the file is NULL."""
    listed = "array<string>"
    return spark.read.schema(
        "enc_len int, dec_len int, frequency string, timezone string, quantiles array<double>, "
        f"features struct<continuous_obs: {listed}, known_future: {listed}, static_real: {listed}>"
    ).json(path)


def manifest_columns(manifest: DataFrame) -> DataFrame:
    """``role, column`` and the settings of a manifest, one row per listed column."""
    roles = manifest.schema["features"].dataType.names
    each = F.array(*[F.struct(F.lit(r).alias("role"), F.col("features")[r].alias("names")) for r in roles])
    out = manifest.select("*", F.explode(each).alias("_r"))
    return out.select("_r.role", F.explode("_r.names").alias("column"), *[c for c in manifest.columns if c != "features"])


def failure_rows(
    polls: DataFrame, records: DataFrame, poll_id: str = "page_id", poll_time: str = "poll_time"
) -> DataFrame:
    """One row for each poll that gave no record: ``timestamp, status_code, params, content``.

    Content over 5,000 characters is cut and marked, shorter content loses its newlines.
    """
    require(polls, poll_id, poll_time, "status_code", "params", "content")
    empty = polls.join(records.select(poll_id).distinct(), poll_id, "left_anti")
    text = F.col("content")
    short = F.regexp_replace(text, r"\n", " ")
    return empty.select(
        F.date_format(poll_time, "yyyy-MM-dd HH:mm").alias("timestamp"),
        "status_code", "params",
        F.when(F.length(text) > CONTENT_LIMIT, F.concat(F.substring(text, 1, CONTENT_LIMIT), F.lit("…")))
        .otherwise(F.regexp_replace(short, r"(?U)^\s+|\s+$", ""))
        .alias("content"),
        F.date_format(poll_time, "yyyy-MM").alias("month"),
    )


def write_known_future(training: DataFrame, inference: DataFrame, path: str, mode: str = "errorifexists") -> dict[str, str]:
    """Covariates of training pairs and of the steps to forecast, as two Parquet folders."""
    out = {"training": f"{path}/training", "inference": f"{path}/inference"}
    for df, folder in zip((training, inference), out.values()):
        df.write.mode(mode).parquet(folder)
    return out


def append_records(records: DataFrame, path: str, poll_time: str = "poll_time", batch_id: str | None = None) -> str:
    """Append records to ``month=yyyy-MM`` folders by poll time; readable by the crawl
    source, which takes the year from the folder.

    With a ``batch_id`` they go under ``batch={batch_id}``, which a repeated append of the
    same batch replaces as a whole: a job may be run again after any failure. The crawl source
    reads batches in the order of their names, so ids must sort by time.
    """
    rows = records.withColumn("month", F.date_format(poll_time, "yyyy-MM")).select(*RAW_COLUMNS, "month")
    return _append(rows, path, batch_id)


def append_failures(failures: DataFrame, path: str, batch_id: str | None = None) -> str:
    """Append failure rows to month folders of their own, apart from the records; ``batch_id``
    as for the records."""
    return _append(failures, path, batch_id)


def _append(rows: DataFrame, path: str, batch_id: str | None) -> str:
    if batch_id is not None and not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"a batch id is made of letters, digits and _ . -: {batch_id!r}")
    at, mode = (path, "append") if batch_id is None else (f"{path}/batch={batch_id}", "overwrite")
    rows.write.mode(mode).partitionBy("month").option("header", True).csv(at)
    return path


def append_polls(polls: DataFrame, records: DataFrame, path: str, failures_path: str, batch_id: str, poll_id: str = "page_id", poll_time: str = "poll_time") -> None:
    """One run of polls: its records, and a failure row for each poll that gave none.

    Both are written under the batch, failures last: a run that broke off in between is
    repeated under the same id and leaves nothing twice.
    """
    append_records(records, path, poll_time, batch_id)
    append_failures(failure_rows(polls, records, poll_id, poll_time), failures_path, batch_id)
