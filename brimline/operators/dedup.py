"""Keep-last deduplication, union, ordered output, head and tail of a series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.operators.features import add_position
from brimline.schema import LENGTH, POSITION, SITE, TIME


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column], drop: list[str] = ()) -> DataFrame:
    """The last row per key by ``order``; NULL keys count as equal.

    An aggregate, not a ranking: each task first reduces its own rows, so a key that holds
    a large share of the rows reaches the shuffle as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    picked = {c: F.col("_r")[c] for c in rest if c not in drop}
    return best.withColumns(picked).select(*[c for c in df.columns if c not in drop])


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns a frame lacks are NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sorted_by_series(df: DataFrame, site: str = SITE, time: str = TIME) -> DataFrame:
    """Total order by site and time, for ordered output only."""
    return df.repartitionByRange(site, time).sortWithinPartitions(site, time)


def tail(df: DataFrame, n: int, site: str = SITE, time: str = TIME) -> DataFrame:
    """Last ``n`` rows of every series."""
    placed = add_position(df, site, time)
    out = placed.filter(F.col(POSITION) >= F.col(LENGTH) - F.lit(n))
    return out.drop(*[c for c in (POSITION, LENGTH) if c not in df.columns])


def head_steps(forecast: DataFrame, n: int, step: str = "step") -> DataFrame:
    """First ``n`` steps of every forecast."""
    return forecast.filter(F.col(step) <= n)
