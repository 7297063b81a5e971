"""Time-ordered splits and standard scaling fitted on the train part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.operators.features import add_position
from brimline.schema import (
    LENGTH,
    POSITION,
    SITE,
    TARGET,
    TIME,
    TRAIN_RATIO,
    VAL_RATIO,
    require,
    scaler_groups,
)

SPLIT = "split"


def split_by_ratio(
    df: DataFrame,
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
    site: str = SITE,
    time: str = TIME,
) -> DataFrame:
    """Add ``split``: the first part of each series is train, then val, the rest test.

    Cuts are truncated products of the series length. On a regular panel this is a plain
    projection over ``time_idx`` and ``series_len``.
    """
    placed = add_position(df, site, time)
    n = F.col(LENGTH).cast("double")
    cut = lambda ratio: F.floor(n * F.lit(float(ratio)))
    label = (
        F.when(F.col(POSITION) < cut(train_ratio), F.lit("train"))
        .when(F.col(POSITION) < cut(train_ratio + val_ratio), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    added = [c for c in (POSITION, LENGTH) if c not in df.columns]
    return placed.withColumn(SPLIT, label).drop(*added)


def split_by_date(
    df: DataFrame, train_end: str, val_end: str, time: str = TIME
) -> DataFrame:
    """Add ``split`` by calendar: up to ``train_end`` train, up to ``val_end`` val."""
    require(df, time)
    ends = [F.lit(x).cast("timestamp") for x in (train_end, val_end)]
    label = (
        F.when(F.col(time) <= ends[0], F.lit("train"))
        .when(F.col(time) <= ends[1], F.lit("val"))
        .when(F.col(time).isNotNull(), F.lit("test"))
    )
    return df.withColumn(SPLIT, label)


def fit_scalers(train: DataFrame) -> DataFrame:
    """Mean and scale of every scaled column over all series, one aggregate pass.

    Long form ``(group, column, mean, scale)``, a few rows whatever the data size. The
    scale is the population standard deviation, 1 for a constant column; NULLs are
    skipped. Write it beside the model: forecasts must be unscaled with the same numbers.
    """
    pairs = [(g, c) for g, cols in scaler_groups(train).items() for c in cols]
    if not pairs:
        raise ValueError("no column to scale")
    aggs = []
    for _, c in pairs:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    entries = [
        F.struct(
            F.lit(g).alias("group"),
            F.lit(c).alias("column"),
            F.col(f"m_{c}").alias("mean"),
            F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")).alias("scale"),
        )
        for g, c in pairs
    ]
    return train.agg(*aggs).select(F.inline(F.array(*entries)))


def fit_moments(df: DataFrame, part: str) -> DataFrame:
    """``(part, group, column, n, mean, m2)`` of every scaled column: count, mean and summed
    squared deviation, per value of ``part`` (a month, say).

    The state of a growing table: new parts are fitted alone and kept beside the old ones, and
    :func:`scalers_of` puts them together without reading a row again.
    """
    require(df, part)
    pairs = [(g, c) for g, cols in scaler_groups(df).items() for c in cols]
    if not pairs:
        raise ValueError("no column to scale")
    aggs = []
    for _, c in pairs:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"m_{c}"), (F.var_pop(x) * F.count(x)).alias(f"q_{c}")]
    entries = [
        F.struct(F.lit(g).alias("group"), F.lit(c).alias("column"), *[F.col(f"{k}_{c}").alias(name) for k, name in (("n", "n"), ("m", "mean"), ("q", "m2"))])
        for g, c in pairs
    ]
    return df.groupBy(F.col(part).alias("part")).agg(*aggs).select("part", F.inline(F.array(*entries)))


def scalers_of(moments: DataFrame) -> DataFrame:
    """Scaler statistics as of :func:`fit_scalers` from moments of parts, each part once.

    Deviations are taken from the common mean before they are added, so no digits are lost.
    """
    keys = ["group", "column"]
    seen = moments.filter(F.col("n") > 0)
    total = seen.groupBy(*keys).agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    away = F.col("mean") - F.col("_mean")
    scale = F.sqrt(F.sum(F.col("m2") + F.col("n") * away * away) / F.first("_n"))
    joined = seen.join(total, keys).groupBy(*keys).agg(F.first("_mean").alias("mean"), scale.alias("scale"))
    every = moments.select(*keys).distinct().join(joined, keys, "left")
    return every.select(*keys, "mean", F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale")).alias("scale"))


def _one_row(stats: DataFrame) -> DataFrame:
    """Scaler statistics as one row holding a map; always one row, so safe to broadcast."""
    entry = F.struct("column", F.struct("mean", "scale"))
    return stats.agg(F.map_from_entries(F.collect_list(entry)).alias("_scalers"))


def apply_scalers(df: DataFrame, stats: DataFrame) -> DataFrame:
    """``(x - mean) / scale`` for the scaled columns that are present.

    Lag and rolling columns of the target are left in original units.
    """
    columns = [c for cols in scaler_groups(df).values() for c in cols]

    def scaled(c: str) -> Column:
        s = F.col("_scalers")[c]
        x = F.col(c).cast("double")
        return F.when(s.isNull(), x).otherwise((x - s["mean"]) / s["scale"])

    wide = df.crossJoin(F.broadcast(_one_row(stats)))
    return wide.withColumns({c: scaled(c) for c in columns}).drop("_scalers")


def unscale(
    df: DataFrame, stats: DataFrame, columns: list[str], target: str = TARGET
) -> DataFrame:
    """Back to the units of ``target``: ``x * scale + mean`` with its train statistics.

    Columns pass through unchanged when the target was not scaled.
    """
    only = stats.filter((F.col("group") == "obs") & (F.col("column") == target))
    wide = df.crossJoin(F.broadcast(_one_row(only)))
    s = F.col("_scalers")[target]
    back = {c: F.when(s.isNull(), F.col(c)).otherwise(F.col(c) * s["scale"] + s["mean"]) for c in columns}
    return wide.withColumns(back).drop("_scalers")
