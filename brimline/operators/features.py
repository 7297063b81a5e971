"""Calendar, lag and rolling features, feature fill, and position in the series.

Lag and rolling windows never cross a series border, and run inside bounded time chunks
that carry the rows they look back on (see plans/chunks.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.functions.time import calendar, floor_div
from brimline.plans.chunks import CHUNK, CHUNK_STEPS, by_chunk, chunk_window, core, with_halo
from brimline.schema import (
    LAGS,
    LENGTH,
    POSITION,
    ROLL_STATS,
    ROLL_WINDOWS,
    SITE,
    TARGET,
    TIME,
    TIMEZONE,
    require,
)
from brimline.session import settled


def add_calendar(df: DataFrame, time: str = TIME, tz: str = TIMEZONE) -> DataFrame:
    """``hour``, ``dow`` (Monday = 0), ``doy``, their sine/cosine pairs, ``is_weekend``."""
    require(df, time)
    return df.withColumns(calendar(F.col(time), tz))


#: Rows up to which a series may be ranked by one task.
WHOLE_SERIES = 1_000_000


def add_position(df: DataFrame, site: str = SITE, time: str = TIME, whole: int = WHOLE_SERIES) -> DataFrame:
    """0-based ``time_idx`` in time order and ``series_len`` of every series; ties in any order.

    A regular panel already has both and is returned as it is. Otherwise series of up to
    ``whole`` rows are ranked each by a task. Rows of longer ones are put in order of series
    and time over all tasks, also within one instant; a segment, the part of a series that
    one task holds, is ranked by itself, and the counts of the segments before it are added.
    """
    require(df, site, time)
    if POSITION in df.columns and LENGTH in df.columns:
        return df
    rows = df.drop(POSITION, LENGTH)
    sizes = rows.groupBy(site).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > whole)
    long = settled(sizes.select(F.col(site).alias("_long")), "long-series")
    if long.isEmpty():
        return _ranked_whole(rows, site, time)
    is_long = F.col(site).eqNullSafe(F.col("_long"))
    return _ranked_whole(rows.join(long, is_long, "left_anti"), site, time).unionByName(
        _ranked_by_segments(rows.join(long, is_long, "left_semi"), site, time)
    )


def _ranked_whole(rows: DataFrame, site: str, time: str) -> DataFrame:
    series = Window.partitionBy(site)
    at = (F.row_number().over(series.orderBy(time)) - 1).cast("bigint")
    return rows.withColumns({POSITION: at, LENGTH: F.count(F.lit(1)).over(series)})


def _ranked_by_segments(rows: DataFrame, site: str, time: str) -> DataFrame:
    tie = F.xxhash64(*rows.columns)
    # more segments than tasks, so that their hashes spread evenly
    parts = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("_tie", tie).repartitionByRange(parts, site, time, "_tie")
    # written, so that a row keeps its segment whatever is read again
    ordered = settled(ordered.withColumn(CHUNK, F.spark_partition_id()), "series-segments")
    counts = ordered.groupBy(site, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    series = Window.partitionBy(site)  # one row per task that has some of the series
    before = series.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(site).alias("_site"), F.col(CHUNK).alias("_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(series).alias(LENGTH),
    )
    inside = F.row_number().over(Window.partitionBy(site, CHUNK).orderBy(time, "_tie")) - 1
    placed = by_chunk(ordered, site).withColumn("_at", inside)
    out = placed.join(starts, F.col(site).eqNullSafe(F.col("_site")) & (F.col(CHUNK) == F.col("_part")))
    out = out.withColumn(POSITION, (F.col("_base") + F.col("_at")).cast("bigint"))
    return out.select(*rows.columns, POSITION, LENGTH)


def look_back(lags: list[int], windows: list[int]) -> int:
    """Rows before a row that its lag and rolling features need."""
    return max([0, *lags, *windows])


# Most pieces a rolling window is put together from in one step.
_MAX_PIECES = 16


def with_lags_rollings(
    df: DataFrame, target: str, lags: list[int], windows: list[int], stats: list[str], w
) -> DataFrame:
    """Lags, and rolling statistics over the *previous* rows (the current one is left out).

    A statistic is NULL unless a third of the window (at least one value) is present; the
    standard deviation is the sample one and NULL for a single value.

    A sliding frame would re-aggregate every row of the frame for each output row. Here
    the (count, mean, squared deviation) of a long window is merged from those of shorter
    ones some rows back, e.g. 168 = 7 x 24, 24 = 2 x 12: a handful of lags over one sort,
    and no running difference that would lose digits.
    """
    unknown = set(stats) - {"mean", "std"}
    if unknown:
        raise ValueError(f"unknown rolling statistics: {sorted(unknown)}")
    out = df.withColumns({f"{target}_lag_{n}": F.lag(target, n).over(w) for n in lags})
    if not windows or not stats:
        return out
    y = F.col(target).cast("double")
    out = out.withColumns(
        {
            "_n0": F.when(y.isNotNull(), 1.0).otherwise(0.0),
            "_m0": F.coalesce(y, F.lit(0.0)),
            "_q0": F.lit(0.0),
        }
    )
    built: list[int] = []
    for size in sorted(set(windows)):
        out = _build_window(out, size, built, w)
        n, q = F.col(f"_n{size}"), F.col(f"_q{size}")
        enough = n >= max(1, size // 3)
        if "mean" in stats:
            out = out.withColumn(f"{target}_rolling_mean_{size}", F.when(enough, F.col(f"_m{size}")))
        if "std" in stats:
            std = F.sqrt(q / F.when(n > 1, n - 1))
            out = out.withColumn(f"{target}_rolling_std_{size}", F.when(enough, std))
    return out.drop(*[f"_{k}{v}" for v in [0, *built] for k in "nmq"])


def _build_window(df: DataFrame, size: int, built: list[int], w) -> DataFrame:
    """Add the statistics of the ``size`` rows before each row, from pieces built before."""
    if size in built:
        return df
    parts = [v for v in built if size % v == 0 and size // v <= _MAX_PIECES]
    if parts:
        piece = max(parts)
        pieces = [(piece, shift) for shift in range(0, size, piece)]
    elif size <= _MAX_PIECES:
        pieces = [(0, shift) for shift in range(1, size + 1)]  # single rows
    else:
        piece = max((v for v in range(2, size // 2 + 1) if size % v == 0), default=size - 1)
        df = _build_window(df, piece, built, w)
        if piece == size - 1:
            pieces = [(piece, 0), (0, size)]
        else:
            pieces = [(piece, shift) for shift in range(0, size, piece)]
    back = {}
    for piece, shift in pieces:
        for k in "nmq":
            if shift and not (piece == 0 and k == "q"):
                back[f"_{k}{piece}_{shift}"] = F.lag(f"_{k}{piece}", shift, 0.0).over(w)
    df = df.withColumns(back)

    def part(k: str, piece: int, shift: int) -> Column:
        if piece == 0 and k == "q":
            return F.lit(0.0)
        return F.col(f"_{k}{piece}_{shift}" if shift else f"_{k}{piece}")

    def total(terms: list[Column]) -> Column:
        return sum(terms[1:], terms[0])

    n, m = f"_n{size}", f"_m{size}"
    df = df.withColumn(n, total([part("n", *p) for p in pieces]))
    weighted = total([part("n", *p) * part("m", *p) for p in pieces])
    df = df.withColumn(m, F.when(F.col(n) > 0, weighted / F.col(n)).otherwise(0.0))
    spread = [part("n", *p) * (part("m", *p) - F.col(m)) * (part("m", *p) - F.col(m)) for p in pieces]
    inner = [part("q", *p) for p in pieces if p[0] != 0]
    df = df.withColumn(f"_q{size}", total(spread + inner))
    built.append(size)
    return df.drop(*back)


def add_lags_rollings(
    df: DataFrame,
    target: str = TARGET,
    lags: list[int] = LAGS,
    windows: list[int] = ROLL_WINDOWS,
    stats: list[str] = ROLL_STATS,
    site: str = SITE,
    time: str = TIME,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Add ``{target}_lag_{n}``, ``{target}_rolling_mean_{n}`` and ``..._std_{n}``.

    Both stay inside a series; for a single series this equals rolling over the whole
    frame.
    """
    require(df, site, time, target)
    placed = add_position(df, site, time)
    chunked = with_halo(placed, site, POSITION, back=look_back(lags, windows), chunk_steps=chunk_steps)
    w = chunk_window(site, POSITION)
    out = core(with_lags_rollings(chunked, target, lags, windows, stats, w))
    added = [c for c in (POSITION, LENGTH) if c not in df.columns]
    return out.drop(*added)


def fill_features(
    df: DataFrame,
    columns: list[str],
    site: str = SITE,
    time: str = TIME,
    backward: bool = True,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Fill gaps of ``columns`` from the value before, then (optionally) the value after.

    Filling stays inside each series, both ways. The backward fill takes values from the
    future of a row; switch it off where that leaks.
    """
    require(df, site, time, *columns)
    if not columns:
        return df
    placed = add_position(df, site, time)
    rows = placed.withColumn(CHUNK, floor_div(F.col(POSITION), chunk_steps))
    pos = F.col(POSITION)

    ends = []
    for i, c in enumerate(columns):
        at = F.when(F.col(c).isNotNull(), pos)
        ends += [F.min_by(c, at).alias(f"_f_{i}"), F.max_by(c, at).alias(f"_l_{i}")]
    pieces = rows.groupBy(site, CHUNK).agg(*ends)
    whole = Window.unboundedPreceding
    before = Window.partitionBy(site).orderBy(CHUNK).rowsBetween(whole, -1)
    after = Window.partitionBy(site).orderBy(F.desc(CHUNK)).rowsBetween(whole, -1)
    past = {f"_p_{i}": F.last(f"_l_{i}", True).over(before) for i, _ in enumerate(columns)}
    future = {f"_n_{i}": F.last(f"_f_{i}", True).over(after) for i, _ in enumerate(columns)}
    carried = pieces.withColumns(past).withColumns(future)

    def edge(kind: int, side: str) -> Column:
        values = [F.col(f"_{side}_{i}").alias(c) for i, c in enumerate(columns)]
        return F.struct(F.lit(kind).alias("_kind"), *values)

    edges = carried.select(site, CHUNK, F.inline(F.array(edge(0, "p"), edge(2, "n"))))
    marked = rows.withColumn("_kind", F.lit(1))
    together = by_chunk(marked.unionByName(edges, allowMissingColumns=True), site)
    part = Window.partitionBy(site, CHUNK)
    up = part.orderBy("_kind", POSITION).rowsBetween(whole, Window.currentRow)
    down = part.orderBy(F.desc("_kind"), F.desc(POSITION)).rowsBetween(whole, Window.currentRow)
    filled = together.withColumns({c: F.last(c, True).over(up) for c in columns})
    if backward:
        # Only what has no value before it is still NULL, so this never overrides a carry.
        filled = filled.withColumns({c: F.last(c, True).over(down) for c in columns})
    added = [c for c in (POSITION, LENGTH) if c not in df.columns]
    return filled.filter(F.col("_kind") == 1).select(*placed.columns).drop(*added)
