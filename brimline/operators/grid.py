"""Regular time grid per series with bounded gap filling.

Plan shape: one aggregate pass makes a small summary per ``(site, chunk)``, from which
*boundary rows* are derived: the first grid point of each chunk with the last known values
before it, and an end mark with the next known values after it. Boundary rows and
observations go through **one** shuffle by ``(site, chunk)``; every gap is then filled
inside its chunk by a projection, without joining a grid and without a per-site task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brimline.functions.time import floor_div, from_micros, micros, step_micros
from brimline.plans.chunks import CHUNK, CHUNK_STEPS, HALO, by_chunk, core
from brimline.schema import FREQUENCY, LENGTH, POSITION, SITE, TIME, require

IMPUTED = "was_imputed"
FILL_LIMIT = 48
MAX_GRID_STEPS = 100_000_000

_START, _OBSERVED, _END = 0, 1, 2


def numeric_columns(df: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value to Spark but a gap to every operator here."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def regularize(
    df: DataFrame,
    frequency: str | int = FREQUENCY,
    site: str = SITE,
    time: str = TIME,
    fill: bool = True,
    limit: int = FILL_LIMIT,
    chunk_steps: int = CHUNK_STEPS,
    max_steps: int = MAX_GRID_STEPS,
) -> DataFrame:
    """Every series on a grid of one step from its first to its last observation.

    * The grid starts at the first observation of the series, not at a clock hour. Rows
      off the grid are dropped; two rows of one series at one time are an error.
    * Numeric columns are interpolated linearly in time up to ``limit`` steps from either
      side of a gap, the rest is carried forward, then backward. They come out as double.
    * ``was_imputed`` is 1 where any column was missing before filling.
    * ``time_idx`` (0-based position) and ``series_len`` come for free with the grid and
      spare later operators a ranking and a count.

    ``fill=False`` leaves the gaps NULL.
    """
    chunked = regularize_chunks(
        df, frequency, site, time, fill, limit, chunk_steps, max_steps, halo=0
    )
    return core(chunked)


def regularize_chunks(
    df: DataFrame,
    frequency: str | int = FREQUENCY,
    site: str = SITE,
    time: str = TIME,
    fill: bool = True,
    limit: int = FILL_LIMIT,
    chunk_steps: int = CHUNK_STEPS,
    max_steps: int = MAX_GRID_STEPS,
    halo: int = 0,
) -> DataFrame:
    """As :func:`regularize`, left partitioned by ``(site, chunk)`` with ``halo`` rows
    before each chunk, for windows that look back without another shuffle."""
    require(df, site, time)
    if not 0 <= halo <= chunk_steps:
        raise ValueError("halo must lie between 0 and chunk_steps")
    step = step_micros(frequency)
    span = step * chunk_steps
    values = numeric_columns(df, (site, time, IMPUTED))
    others = [c for c in df.columns if c not in (site, time, IMPUTED, *values)]

    t = F.col("_t")
    rows = (
        nan_to_null(df.drop(IMPUTED))
        .filter(F.col(time).isNotNull() & F.col(site).isNotNull())
        .withColumns({c: F.col(c).cast("double") for c in values})
        .withColumn("_t", micros(F.col(time)))
        .withColumn(CHUNK, floor_div(t, span))
        .withColumn("_phase", F.pmod(t, F.lit(step)))
    )
    edges = _boundary_rows(rows, site, values, step, span, halo, max_steps)

    # An observation is seen by its own chunk and, near the end of it, by the next one.
    next_start = (F.col(CHUNK) + 1) * F.lit(span) + F.col("_phase")
    seen_by = F.array(F.col(CHUNK))
    if halo:
        seen_by = F.when(
            t >= next_start - F.lit(halo * step), F.array(F.col(CHUNK), F.col(CHUNK) + 1)
        ).otherwise(seen_by)
    missing = [F.col(c).isNull() for c in [*values, *others]]
    observed = rows.select(
        site, "_t", "_phase",
        F.explode(seen_by).alias(CHUNK),
        F.lit(_OBSERVED).alias("_kind"),
        reduce(Column.__or__, missing, F.lit(False)).alias("_gap"),
        *others,
        *[F.col(c).alias(f"_y_{i}") for i, c in enumerate(values)],
        *[F.when(F.col(c).isNotNull(), t).alias(f"_t_{i}") for i, c in enumerate(values)],
    )
    together = by_chunk(observed.unionByName(edges, allowMissingColumns=True), site)

    part = Window.partitionBy(site, CHUNK)
    backward = part.orderBy(F.desc("_t"), F.desc("_kind"))
    forward = part.orderBy(F.asc("_t"), F.asc("_kind"))
    so_far = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = backward.rowsBetween(Window.unboundedPreceding, -1)

    # The start row sorts first and brings the anchor; rows off its phase are not on the grid.
    # A chunk that only got halo copies has no start row and vanishes here.
    on_grid = (
        together.withColumn("_anchor", F.last("_anchor", True).over(so_far))
        .withColumn(LENGTH, F.last(LENGTH, True).over(so_far))
        .filter(F.pmod(t - F.col("_anchor"), F.lit(step)) == 0)
    )
    known = {}
    for i, _ in enumerate(values):
        known[f"_pt_{i}"] = F.last(f"_t_{i}", True).over(so_far)
        known[f"_py_{i}"] = F.last(f"_y_{i}", True).over(so_far)
    known["_next"] = F.lead("_t").over(forward)
    known["_next_kind"] = F.lead("_kind").over(forward)
    ahead = {}
    for i, _ in enumerate(values):
        ahead[f"_nt_{i}"] = F.last(f"_t_{i}", True).over(after)
        ahead[f"_ny_{i}"] = F.last(f"_y_{i}", True).over(after)
    spans = on_grid.withColumns(known)  # same sort as the anchor window
    if fill and values:
        spans = spans.withColumns(ahead)

    same_time = (F.col("_next") == t) & (F.col("_kind") == _OBSERVED)
    checked_next = F.when(
        same_time & (F.col("_next_kind") == _OBSERVED),
        F.raise_error(F.lit("two rows of one series at one time; deduplicate first")).cast("bigint"),
    ).otherwise(F.col("_next"))
    emitted = (
        spans.withColumn("_next", checked_next)
        .filter((F.col("_kind") != _END) & (F.col("_next") > t))
        .withColumn("_g", F.explode(F.sequence(t, F.col("_next") - F.lit(step), F.lit(step))))
    )

    g = F.col("_g")
    is_obs = (F.col("_kind") == _OBSERVED) & (g == t)
    filled = []
    for i, c in enumerate(values):
        y = F.when(is_obs, F.col(f"_y_{i}"))
        if fill:
            y = F.coalesce(y, _fill(i, g, step, limit))
        filled.append(y.alias(c))
    first_core = (F.col(CHUNK) * F.lit(span)) + F.pmod(F.col("_anchor"), F.lit(step))
    return emitted.select(
        F.col(site),
        from_micros(g).alias(time),
        *[F.when(is_obs, F.col(c)).alias(c) for c in others],
        *filled,
        F.when(is_obs & ~F.col("_gap"), 0).otherwise(1).alias(IMPUTED),
        floor_div(g - F.col("_anchor"), step).alias(POSITION),
        F.col(LENGTH),
        F.col(CHUNK),
        (g < first_core).alias(HALO),
    )


def _fill(i: int, g: Column, step: int, limit: int) -> Column:
    """Value at grid time ``g`` from the known neighbours of column ``i``.

    Between two known points: linear in time within ``limit`` steps of either; the middle
    of a longer gap stays flat at the value ``limit`` steps in. At the ends: carried.
    """
    pt, py = F.col(f"_pt_{i}"), F.col(f"_py_{i}")
    nt, ny = F.col(f"_nt_{i}"), F.col(f"_ny_{i}")
    reach = F.lit(limit * step)
    since = F.when((g - pt <= reach) | (nt - g <= reach), g - pt).otherwise(reach)
    return (
        F.when(pt.isNull(), ny)
        .when(nt.isNull(), py)
        .otherwise(py + (ny - py) * since / (nt - pt))
    )


def _boundary_rows(
    rows: DataFrame, site: str, values: list[str], step: int, span: int, halo: int, max_steps: int
) -> DataFrame:
    """Start and end row of every chunk of every series, with what lies beyond.

    Only aggregates with map-side combining touch the data; what is left has one row per
    chunk (and per phase of off-grid rows, which are gone once the anchor is known).
    """
    t = F.col("_t")
    aggs = [F.min(t).alias("_lo"), F.max(t).alias("_hi")]
    next_start = (F.col(CHUNK) + 1) * F.lit(span) + F.col("_phase")
    for i, c in enumerate(values):
        at = F.when(F.col(c).isNotNull(), t)
        aggs += [
            F.min(at).alias(f"_ft_{i}"), F.min_by(c, at).alias(f"_fy_{i}"),
            F.max(at).alias(f"_lt_{i}"), F.max_by(c, at).alias(f"_ly_{i}"),
        ]
        if halo:  # last known before the halo of the next chunk
            body = F.when(t < next_start - F.lit(halo * step), at)
            aggs += [F.max(body).alias(f"_bt_{i}"), F.max_by(c, body).alias(f"_by_{i}")]
    pieces = rows.groupBy(site, CHUNK, "_phase").agg(*aggs)

    length = floor_div(F.col("_hi") - F.col("_anchor"), step) + 1
    too_long = F.raise_error(
        F.format_string("series %s needs %d grid steps", F.col(site).cast("string"), length)
    ).cast("bigint")
    series = (
        pieces.groupBy(site)
        .agg(F.min("_lo").alias("_anchor"), F.max("_hi").alias("_hi"))
        .withColumn(LENGTH, F.when(length > max_steps, too_long).otherwise(length))
        .withColumn("_phase", F.pmod("_anchor", F.lit(step)))
        .withColumn("_stop", F.col("_anchor") + F.col(LENGTH) * F.lit(step))
    )
    first = floor_div(F.col("_anchor"), span)
    last = floor_div(F.col("_stop") - F.lit(step), span)
    chunks = series.withColumn(CHUNK, F.explode(F.sequence(first, last))).drop("_hi")
    # Each chunk with its piece, if any row fell into it. Grouped, not joined: a join would
    # push its own key filters into one side, and the scan and shuffle behind `rows` could
    # no longer be shared with the main branch. Pieces off the anchor's phase drop out.
    keys = [site, CHUNK, "_phase"]
    both = chunks.unionByName(pieces.drop("_lo", "_hi"), allowMissingColumns=True)
    merged = [F.max(c).alias(c) for c in both.columns if c not in keys]
    per_chunk = both.groupBy(*keys).agg(*merged).filter(F.col("_anchor").isNotNull())

    # One row per chunk from here on, so a window per series is small even for a long one.
    up = Window.partitionBy(site).orderBy(CHUNK)
    before = up.rowsBetween(Window.unboundedPreceding, -2 if halo else -1)
    down = Window.partitionBy(site).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carried = {}
    for i, _ in enumerate(values):
        for kind in "ty":
            past = F.last(f"_l{kind}_{i}", True).over(before)
            if halo:
                past = F.coalesce(F.lag(f"_b{kind}_{i}").over(up), past)
            carried[f"_past_{kind}_{i}"] = past
    for i, _ in enumerate(values):
        for kind in "ty":
            carried[f"_future_{kind}_{i}"] = F.last(f"_f{kind}_{i}", True).over(down)
    if carried:
        per_chunk = per_chunk.withColumns(carried)

    chunk_start = F.col(CHUNK) * F.lit(span) + F.col("_phase")
    start_at = F.greatest(F.col("_anchor"), chunk_start - F.lit(halo * step))
    end_at = F.least(F.col("_stop"), chunk_start + F.lit(span))

    def edge(kind: int, at: Column, side: str) -> Column:
        fields = [F.lit(kind).alias("_kind"), at.alias("_t")]
        for i, _ in enumerate(values):
            fields += [F.col(f"_{side}_{k}_{i}").alias(f"_{k}_{i}") for k in "ty"]
        return F.struct(*fields)

    return per_chunk.select(
        site, CHUNK, "_anchor", LENGTH, "_phase",
        F.inline(F.array(edge(_START, start_at, "past"), edge(_END, end_at, "future"))),
    )
