"""Encoder/decoder windows over a regular panel.

A row knows the windows it belongs to from its position and the series length alone, so
windows are made by *emitting each row into its windows*: no join and no shuffle. All
functions expect ``time_idx`` and ``series_len`` (see operators/grid.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.functions.time import floor_div, micros, step_micros
from brimline.plans.chunks import CHUNK, CHUNK_STEPS, HALO, by_chunk, chunk_arrays, core, with_halo, with_series
from brimline.schema import (
    DECODER_STEPS,
    ENCODER_STEPS,
    FREQUENCY,
    LENGTH,
    POSITION,
    SITE,
    TARGET,
    TIME,
    require,
)

ORIGIN = "origin_idx"
STEP = "step"


def training_cutoff(df: DataFrame, dec_len: int = DECODER_STEPS) -> DataFrame:
    """One row ``cutoff``: the last position of any series, less the horizon."""
    require(df, POSITION)
    return df.agg((F.max(POSITION) - F.lit(dec_len)).alias("cutoff"))


def cutoff_of_bounds(
    panel: DataFrame, dec_len: int = DECODER_STEPS, frequency: str | int = FREQUENCY, site: str = SITE, time: str = TIME
) -> DataFrame:
    """:func:`training_cutoff` of the grid a panel *will* have, from the first and last time of
    each series: no grid is made for it."""
    require(panel, site, time)
    seen = panel.filter(F.col(time).isNotNull() & F.col(site).isNotNull())
    bounds = seen.groupBy(site).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    last = floor_div(micros(F.col("_b")) - micros(F.col("_a")), step_micros(frequency))
    return bounds.agg((F.max(last) - F.lit(dec_len)).alias("cutoff"))


def with_cutoff(
    df: DataFrame, dec_len: int = DECODER_STEPS, per_site: bool = False, cutoff: DataFrame | None = None
) -> DataFrame:
    """Add ``cutoff``. The global one starves series shorter than the longest; the
    ``per_site`` one is a projection over ``series_len``. ``cutoff`` gives the one row of the
    global one; without it the rows of ``df`` are made twice, once to find it."""
    require(df, POSITION, LENGTH)
    if per_site:
        return df.withColumn("cutoff", F.col(LENGTH) - 1 - F.lit(dec_len))
    one_row = training_cutoff(df, dec_len) if cutoff is None else cutoff
    return df.crossJoin(F.broadcast(one_row))


def window_rows(
    df: DataFrame,
    enc_len: int = ENCODER_STEPS,
    dec_len: int = DECODER_STEPS,
    stride: int = 1,
    site: str = SITE,
    only: str = "all",
    per_site: bool = False,
    cutoff: DataFrame | None = None,
) -> DataFrame:
    """Windows in long form: one row per window and step.

    A window has ``enc_len`` rows up to its origin (``step`` -enc_len+1 .. 0) and
    ``dec_len`` rows after it (``step`` 1 .. dec_len); only complete windows come out.
    ``only="train"`` keeps windows that end at or before the training cutoff,
    ``"validation"`` those whose first predicted row lies after it, ``"last"`` the last
    complete window of each series. ``relative_idx`` counts in encoder lengths from the
    first predicted row. ``cutoff`` may come from :func:`cutoff_of_bounds`.

    Rows grow by ``(enc_len + dec_len) / stride``; raise ``stride`` for long histories.
    """
    require(df, site, POSITION, LENGTH)
    last = F.col(LENGTH) - 1 - F.lit(dec_len)  # last origin with a full decoder
    low = F.greatest(F.col(POSITION) - F.lit(dec_len), F.lit(enc_len - 1).cast("bigint"))
    high = F.least(F.col(POSITION) + F.lit(enc_len - 1), last)
    if only in ("train", "validation"):
        df = with_cutoff(df, dec_len, per_site, cutoff)
        if only == "train":
            high = F.least(high, F.col("cutoff") - F.lit(dec_len))
        else:
            low = F.greatest(low, F.col("cutoff"))
    elif only == "last":
        low = F.greatest(low, last)
    elif only != "all":
        raise ValueError(f"unknown window set: {only!r}")
    # Origins are the multiples of the stride, counted from the first complete window.
    base = F.lit(enc_len - 1).cast("bigint")
    if stride != 1 and only != "last":
        low = base + floor_div(low - base + F.lit(stride - 1), stride) * F.lit(stride)
    origins = F.when(high >= low, F.sequence(low, high, F.lit(stride).cast("bigint")))
    out = df.withColumn(ORIGIN, F.explode(origins))
    step = F.col(POSITION) - F.col(ORIGIN)
    return out.withColumns(
        {
            STEP: step.cast("int"),
            "relative_idx": (step - 1) / F.lit(float(enc_len)),
        }
    ).drop("cutoff")


def window_arrays(
    df: DataFrame,
    columns: list[str],
    enc_len: int = ENCODER_STEPS,
    dec_len: int = DECODER_STEPS,
    stride: int = 1,
    site: str = SITE,
    only: str = "all",
    chunk_steps: int = CHUNK_STEPS,
    cutoff: DataFrame | None = None,
) -> DataFrame:
    """One row per window with ``encoder`` and ``decoder`` arrays of structs in time order.

    Each chunk with its halo is one array, and a window is two slices of it, cut at the
    origins wanted only: no row travels into the windows it is part of, and after the
    exchange by chunk there is no other. Windows over positions that are missing are left
    out.
    """
    require(df, site, POSITION, LENGTH, *columns)
    steps = max(chunk_steps, enc_len + dec_len)
    wanted = _origin_wanted(enc_len, dec_len, stride, only)
    if only in ("train", "validation"):
        df = with_cutoff(df, dec_len, cutoff=cutoff)
    marked = df.withColumn("_wanted", wanted)
    chunks = chunk_arrays(marked, ["_wanted", *columns], site, POSITION, enc_len - 1, dec_len, steps)
    lists = chunks.select(site, *[F.col(f"_rows.{c}").alias(f"_all_{c}") for c in [POSITION, HALO, "_wanted", *columns]])
    at = F.posexplode(F.transform(F.arrays_zip(f"_all_{HALO}", "_all__wanted"), lambda x: ~x[f"_all_{HALO}"] & x["_all__wanted"]))
    origins = lists.select("*", at.alias("_at", "_yes")).filter("_yes")
    position = lambda i: F.get(f"_all_{POSITION}", i)
    first, last = position(F.col("_at") - (enc_len - 1)), position(F.col("_at") + dec_len)
    origins = origins.withColumn(ORIGIN, position(F.col("_at")))
    origins = origins.filter((F.col(ORIGIN) - first == enc_len - 1) & (last - F.col(ORIGIN) == dec_len))
    out = origins
    for name, begin, size, low in (("encoder", F.col("_at") - (enc_len - 2), enc_len, 1 - enc_len), ("decoder", F.col("_at") + 2, dec_len, 1)):
        cut = {c: F.slice(f"_all_{c}", begin, F.lit(size)) for c in columns}
        numbers = F.sequence(F.lit(low), F.lit(low + size - 1))
        out = out.withColumns({STEP: numbers, **cut}).withColumn(name, F.arrays_zip(STEP, *columns)).drop(STEP, *columns)
    return out.select(site, ORIGIN, "encoder", "decoder")


def _origin_wanted(enc_len: int, dec_len: int, stride: int, only: str) -> Column:
    """Whether a row is an origin of the set, as in :func:`window_rows`."""
    position, last = F.col(POSITION), F.col(LENGTH) - 1 - F.lit(dec_len)
    wanted = (position >= enc_len - 1) & (position <= last)
    if only == "last":
        return wanted & (position == last)
    if only == "train":
        wanted = wanted & (position <= F.col("cutoff") - F.lit(dec_len))
    elif only == "validation":
        wanted = wanted & (position >= F.col("cutoff"))
    elif only != "all":
        raise ValueError(f"unknown window set: {only!r}")
    return wanted & ((position - (enc_len - 1)) % stride == 0)


def has_gaps(df: DataFrame, site: str = SITE, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """Rows whose position does not follow the one before it by one."""
    rows = df.withColumn(CHUNK, floor_div(F.col(POSITION), chunk_steps))
    # one row per chunk: where the chunk before it, however far back, ends
    ends = rows.groupBy(site, CHUNK).agg(F.max(POSITION).alias("_end"))
    ends = ends.select(site, CHUNK, F.lag("_end").over(Window.partitionBy(site).orderBy(CHUNK)).alias("_end"))
    placed = by_chunk(rows, site).join(ends, [site, CHUNK])
    before = F.coalesce(F.lag(POSITION).over(Window.partitionBy(site, CHUNK).orderBy(POSITION)), F.col("_end"))
    marked = placed.withColumn("gap_before", F.col(POSITION) - before - 1)
    return marked.filter(F.col("gap_before") > 0).select(*df.columns, "gap_before")


def target_normalizer(df: DataFrame, target: str = TARGET, site: str = SITE) -> DataFrame:
    """Mean and sample deviation of the target per series."""
    return df.groupBy(site).agg(
        F.avg(target).alias("target_center"), F.stddev_samp(target).alias("target_scale")
    )


def normalize_target(
    df: DataFrame, target: str = TARGET, site: str = SITE, chunk_steps: int = CHUNK_STEPS
) -> DataFrame:
    """Add ``{target}_norm`` by the mean and deviation of each series."""
    require(df, site, target, POSITION)
    stats = target_normalizer(df, target, site)
    rows = core(with_halo(df, site, POSITION, chunk_steps=chunk_steps, series_stats=stats))
    scale = F.when(F.col("target_scale") > 0, F.col("target_scale")).otherwise(1.0)
    value = (F.col(target) - F.col("target_center")) / scale
    return rows.withColumn(f"{target}_norm", value).drop("target_center", "target_scale")


def horizon_pairs(
    df: DataFrame,
    horizon: int,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    chunk_steps: int = CHUNK_STEPS,
    keep: list[str] = (),
    origin_filter: Column | None = None,
    label_keep: list[str] = (),
    series_stats: DataFrame | None = None,
) -> DataFrame:
    """Each row as a forecast origin, paired with its next ``horizon`` rows.

    ``(site, origin_idx, origin_ts, y_origin, step, y)``, plus the ``keep`` columns at the
    origin, ``label_{c}`` for the ``label_keep`` columns of the row ahead, and the columns of
    ``series_stats`` (one row per site). Pairs are read out of the array of a chunk and its
    halo: they never travel through a shuffle, and rows that ``origin_filter`` does not want
    make none. The statistics meet the arrays, not the rows.
    """
    chunks = horizon_chunks(df, horizon, target, site, time, chunk_steps, [*keep, *label_keep], origin_filter)
    return pairs_of(chunks, horizon, target, site, time, keep, label_keep, series_stats)


def horizon_chunks(
    df: DataFrame,
    horizon: int,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    chunk_steps: int = CHUNK_STEPS,
    keep: list[str] = (),
    origin_filter: Column | None = None,
) -> DataFrame:
    """The arrays that :func:`pairs_of` reads, with each row's ``_origin`` mark. Several
    jobs over the same horizon may share them."""
    origin = F.lit(True) if origin_filter is None else F.coalesce(origin_filter, F.lit(False))
    columns = ["_origin", time, target, *keep]
    return chunk_arrays(df.withColumn("_origin", origin), columns, site, POSITION, 0, horizon, max(chunk_steps, horizon))


def pairs_of(
    chunks: DataFrame,
    horizon: int,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    keep: list[str] = (),
    label_keep: list[str] = (),
    series_stats: DataFrame | None = None,
) -> DataFrame:
    """Origins and their next rows out of :func:`horizon_chunks`; see :func:`horizon_pairs`."""
    given = []
    if series_stats is not None:
        given = [c for c in series_stats.columns if c != site]
        chunks = with_series(chunks, series_stats, site)
    kept, labels = list(dict.fromkeys(keep)), list(dict.fromkeys(label_keep))
    columns = list(dict.fromkeys([POSITION, HALO, "_origin", time, target, *kept, *labels]))
    lists = chunks.select(site, *given, *[F.col(f"_rows.{c}").alias(f"_all_{c}") for c in columns])
    size = F.size(f"_all_{POSITION}")
    rows = lists.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("_i"))
    rows = rows.filter(~F.get(f"_all_{HALO}", F.col("_i")) & F.get("_all__origin", F.col("_i")) & (F.col("_i") + 1 < size))
    ahead = F.sequence(F.col("_i") + 1, F.least(F.col("_i") + F.lit(horizon), size - 1))
    pairs = rows.select("*", F.explode(ahead).alias("_j"))
    at = lambda c, i: F.get(f"_all_{c}", F.col(i))
    # Positions may skip where rows were filtered out; a step is a distance, not a count.
    step = (at(POSITION, "_j") - at(POSITION, "_i")).cast("int")
    return pairs.select(
        site, at(time, "_i").alias("origin_ts"), at(POSITION, "_i").alias(ORIGIN), at(target, "_i").alias("y_origin"),
        *[at(c, "_i").alias(c) for c in kept if c not in (time, target, POSITION)], *given,
        step.alias(STEP), at(target, "_j").alias("y"), *[at(c, "_j").alias(f"label_{c}") for c in labels],
    ).filter(F.col(STEP) <= horizon)


def inference_frame(history: DataFrame, known_future: DataFrame) -> DataFrame:
    """History and known-future rows as one frame with an ``is_future`` mark.

    Prepare it like any panel and fit scalers on ``~is_future``: a mark, not a position,
    separates the two, so several series and inserted grid rows are no problem.
    """
    past = history.withColumn("is_future", F.lit(False))
    return past.unionByName(known_future.withColumn("is_future", F.lit(True)), allowMissingColumns=True)


def mark_future(
    df: DataFrame, site: str = SITE, time: str = TIME, chunk_steps: int = CHUNK_STEPS
) -> DataFrame:
    """Restore ``is_future`` after gridding: rows after the last known history row."""
    require(df, site, time, POSITION, "is_future")
    last = df.filter(~F.col("is_future")).groupBy(site).agg(F.max(time).alias("_last"))
    rows = core(with_halo(df, site, POSITION, chunk_steps=chunk_steps, series_stats=last))
    return rows.withColumn("is_future", F.coalesce(F.col(time) > F.col("_last"), F.lit(True))).drop("_last")
