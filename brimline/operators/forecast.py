"""Multi-horizon quantile forecasts per series, and the tables around them.

Every forecast is a long frame ``(site, origin_idx, step, timestamp, q10, q50, q90)``.
Panels must be regular (``time_idx``, ``series_len``; see operators/grid.py).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.functions.ranks import Question, Summary, narrowed, rank_of, summarized
from brimline.functions.stats import grouped_quantiles
from brimline.functions.time import calendar, floor_div, from_micros, micros, step_micros
from brimline.operators.split import SPLIT
from brimline.operators.windows import ORIGIN, STEP, horizon_chunks, horizon_pairs, pairs_of
from brimline.plans.chunks import CHUNK_STEPS, HALO, chunk_window, core, with_halo, with_series
from brimline.schema import (
    DECODER_STEPS,
    FREQUENCY,
    LENGTH,
    POSITION,
    QUANTILES,
    SITE,
    TARGET,
    TIME,
    TIMEZONE,
    require,
)
from brimline.session import scratch_path, settled

BANDS = ["q10", "q50", "q90"]


def _ahead(ts: Column, steps: Column, frequency: str | int) -> Column:
    return from_micros(micros(ts) + steps * F.lit(step_micros(frequency)))


def _output(df: DataFrame, site: str, time: str) -> DataFrame:
    return df.select(site, ORIGIN, F.col(STEP).cast("int").alias(STEP), time, *BANDS)


def last_origin(holdout: int) -> Column:
    """Position of the forecast origin when the last ``holdout`` rows are kept to score."""
    return F.col(LENGTH) - 1 - F.lit(holdout)


def future_timestamps(
    df: DataFrame,
    horizon: int = DECODER_STEPS,
    frequency: str | int = FREQUENCY,
    site: str = SITE,
    time: str = TIME,
) -> DataFrame:
    """The ``horizon`` steps after the last row of each series: ``(site, step, time)``."""
    ends = df.groupBy(site).agg(F.max(time).alias("_last"))
    steps = ends.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(site, STEP, _ahead(F.col("_last"), F.col(STEP), frequency).alias(time))


def persistence_spread(
    train: DataFrame,
    horizon: int,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Quantiles of the ``step``-ahead change per series and step, over the train rows."""
    chunks = settled(horizon_chunks(train, horizon, target, site, time, chunk_steps, [LENGTH]), "spread-chunks")
    return spread_of_chunks(chunks, horizon, target, site, quantiles, chunk_steps)


def spread_of_chunks(
    chunks: DataFrame,
    horizon: int,
    target: str = TARGET,
    site: str = SITE,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
    only: str | None = None,
) -> DataFrame:
    """``(site, step, _lo, _mid, _hi)`` from the arrays of :func:`horizon_chunks`, which must
    be a written table; ``only`` names a split whose rows alone count.

    All steps of a chunk are subtracted and sorted where they lie. A series of one chunk is
    done with that. The chunks of a longer one answer with a summary per step, added up over
    what one task reads before anything is shuffled, and the next pass asks for the narrower
    bounds that follow (see functions/ranks.py); a few passes make it exact.
    """
    one_chunk = max(chunk_steps, horizon)
    qs = [float(q) for q in quantiles]
    size = f"element_at(_rows.{LENGTH}, 1)"
    fields = [f"_rows.{POSITION}", f"_rows.{HALO}", f"_rows.{target}", f"_rows.{SPLIT if only else HALO}"]
    lists = [F.col(c).alias(f"_{i}") for i, c in enumerate(fields)]
    whole = chunks.filter(F.expr(f"{size} <= {one_chunk}")).select(site, *lists)
    kind = whole.schema[site].dataType.simpleString()
    names = ["_lo", "_mid", "_hi"]

    def changes(batch: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Values by position, NaN where there is none, and which are the chunk's own."""
        at, halo, y, split = (batch.column(f"_{i}")[r].values for i in range(4))
        at = at.to_numpy() - at[0].as_py()
        value = np.full(int(at[-1]) + 1, np.nan)
        value[at] = pc.fill_null(y.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
        own = np.zeros(len(value), dtype=bool)
        own[at] = ~halo.to_numpy(zero_copy_only=False)
        if only:
            value[at[~pc.equal(split, only).fill_null(False).to_numpy(zero_copy_only=False)]] = np.nan
        return value, own

    def sorted_changes(parts: list[tuple[np.ndarray, np.ndarray]], step: int) -> np.ndarray:
        d = np.concatenate([(v[step:] - v[:-step])[own[:-step]] if len(v) > step else v[:0] for v, own in parts])
        return np.sort(d[~np.isnan(d)])

    def picked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                part = [changes(batch, r)]
                steps, bands = [], []
                for h in range(1, horizon + 1):
                    d = sorted_changes(part, h)
                    if len(d):
                        steps.append(h)
                        bands.append([d[rank_of(q, len(d)) - 1] for q in qs])
                column = pa.array([batch.column(0)[r]] * len(steps), batch.schema.field(0).type)
                values = np.array(bands).reshape(-1, len(qs)).T
                yield pa.RecordBatch.from_arrays([column, pa.array(steps, pa.int32()), *map(pa.array, values)], names=[site, STEP, *names])

    done = whole.mapInArrow(picked, f"`{site}` {kind}, {STEP} int, _lo double, _mid double, _hi double")
    long = chunks.filter(F.expr(f"{size} > {one_chunk}"))
    if long.isEmpty():
        return done
    return done.unionByName(_long_spread(long, lists, changes, sorted_changes, horizon, site, kind, qs, names))


#: Rows of a series whose changes are sorted together before their summary is sent.
SUMMED_ROWS = 1 << 20

_SUMMARY = "struct<below bigint, probed array<bigint>, inner bigint, samples array<double>>"
_QUESTION = "struct<rank bigint, lo double, hi double, probes array<double>>"


def _long_spread(long, lists, changes, sorted_changes, horizon, site, kind, qs, names) -> DataFrame:
    """The passes of :func:`spread_of_chunks` over series of several chunks."""
    everything = Question(0, -math.inf, math.inf, [])

    def answered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(key, asked, parts) -> pa.RecordBatch:
            out = []
            for h in range(1, horizon + 1):
                questions = asked.get(h) if asked is not None else [everything] * len(qs)
                if questions:
                    d = sorted_changes(parts, h)
                    answers = [summarized(d, Question(*q))._asdict() if q else None for q in questions]
                    if len(d):
                        out.append((key, h, len(d), answers))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [schema.field(0).type, pa.int32(), pa.int64(), arrow]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[site, STEP, "n", "answers"])

        summary = pa.struct([("below", pa.int64()), ("probed", pa.list_(pa.int64())), ("inner", pa.int64()), ("samples", pa.list_(pa.float64()))])
        arrow = pa.list_(summary)
        key, asked, parts, rows, schema = None, None, [], 0, None
        for batch in batches:
            schema = batch.schema
            for r in range(batch.num_rows):
                mine = batch.column(0)[r].as_py()
                if parts and (mine != key or rows >= SUMMED_ROWS):
                    yield told(key, asked, parts)
                    parts, rows = [], 0
                if not parts:
                    given = batch.column("asked")[r].as_py() if "asked" in schema.names else None
                    asked = {x[STEP]: [tuple(q.values()) if q else None for q in x["questions"]] for x in given} if given is not None else None
                key = mine
                parts.append(changes(batch, r))
                rows += len(parts[-1][0])
        if parts:
            yield told(key, asked, parts)

    def concluded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        question = pa.struct([("rank", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()), ("probes", pa.list_(pa.float64()))])
        for batch in batches:
            found, left = [], []
            for r in range(batch.num_rows):
                told = batch.column("told")[r].as_py()
                before = batch.column("questions")[r].as_py() or [None] * len(qs)
                values = batch.column("found")[r].as_py() or [None] * len(qs)
                n, nexts = sum(t["n"] for t in told), []
                for i, q in enumerate(qs):
                    asked = Question(*before[i].values()) if before[i] else everything._replace(rank=rank_of(q, n))
                    result = values[i]
                    if result is None:
                        result = narrowed(asked, [Summary(**t["answers"][i]) for t in told if t["answers"][i] is not None])
                    open_ = isinstance(result, Question)
                    nexts.append(result._asdict() if open_ else None)
                    values[i] = None if open_ else result
                found.append(values)
                left.append(nexts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64())), pa.array(left, pa.list_(question))],
                names=[site, STEP, "found", "questions"],
            )

    rows = long.select(site, *lists)
    state = None
    while True:
        told = rows.mapInArrow(answered, f"`{site}` {kind}, {STEP} int, n bigint, answers array<{_SUMMARY}>")
        told = told.groupBy(site, STEP).agg(F.collect_list(F.struct("n", "answers")).alias("told"))
        if state is None:
            told = told.withColumns({"found": F.lit(None).cast("array<double>"), "questions": F.lit(None).cast(f"array<{_QUESTION}>")})
            rest = None
        else:
            told = told.join(state, [site, STEP])
            rest = state.filter("forall(questions, q -> q IS NULL)")
        told = told.select(site, STEP, "told", "found", "questions")
        now = told.mapInArrow(concluded, f"`{site}` {kind}, {STEP} int, found array<double>, questions array<{_QUESTION}>")
        state = settled(now if rest is None else now.unionByName(rest), "spread-state")
        open_ = state.filter("exists(questions, q -> q IS NOT NULL)")
        if open_.isEmpty():
            return state.select(site, STEP, *[F.col("found")[i].alias(c) for i, c in enumerate(names)])
        asked = open_.groupBy(site).agg(F.collect_list(F.struct(STEP, "questions")).alias("asked"))
        rows = with_series(long, asked, site).filter("asked IS NOT NULL").select(site, *lists, "asked")


def seasonal_spread(
    train: DataFrame,
    seasons: int,
    season: int,
    target: str = TARGET,
    site: str = SITE,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Quantiles of the change over 1 .. ``seasons`` whole seasons, per series.

    Every step of a seasonal forecast looks back a whole number of seasons, so the spread
    depends on that number only: ``seasons`` lags per row instead of one pair per step.
    """
    back = season * seasons
    chunked = with_halo(
        train.select(site, POSITION, target), site, POSITION, back=back, chunk_steps=max(chunk_steps, back)
    )
    w = chunk_window(site, POSITION)
    lags = F.array(*[F.lag(target, season * k).over(w) for k in range(1, seasons + 1)])
    rows = core(chunked.withColumn("_lags", lags))
    changes = rows.select(
        site, F.col(target).alias("_y"), F.posexplode("_lags").alias("_k", "_then")
    ).filter(F.col("_then").isNotNull())
    d = changes.select(site, (F.col("_k") + 1).alias("_k"), (F.col("_y") - F.col("_then")).alias("_d"))
    return grouped_quantiles(d, [site, "_k"], "_d", quantiles, ["_lo", "_mid", "_hi"]).drop("n_obs")


def persistence_forecast(
    df: DataFrame,
    horizon: int = DECODER_STEPS,
    holdout: int = 0,
    frequency: str | int = FREQUENCY,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Last value, spread by the quantiles of past ``step``-ahead changes.

    Changes come from the rows marked ``split = 'train'``, or from all rows up to the
    origin when there is no split. Steps that were never observed have NULL bands.
    """
    require(df, site, time, target, POSITION, LENGTH)
    train = _train_rows(df, holdout)
    spread = persistence_spread(train, horizon, target, site, time, quantiles, chunk_steps)
    origins = df.filter(F.col(POSITION) == last_origin(holdout)).select(
        site, F.col(POSITION).alias(ORIGIN), F.col(time).alias("_t0"), F.col(target).alias("_y0")
    )
    steps = origins.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    joined = steps.join(spread, [site, STEP], "left")
    return _output(
        joined.withColumns(
            {
                time: _ahead(F.col("_t0"), F.col(STEP), frequency),
                "q10": F.col("_y0") + F.col("_lo"),
                "q50": F.col("_y0") + F.col("_mid"),
                "q90": F.col("_y0") + F.col("_hi"),
            }
        ),
        site, time,
    )


def seasonal_forecast(
    df: DataFrame,
    season: int = 168,
    horizon: int = DECODER_STEPS,
    holdout: int = 0,
    frequency: str | int = FREQUENCY,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
    spread: DataFrame | None = None,
) -> DataFrame:
    """Value one season back (repeated), spread by past changes over whole seasons; ``spread``
    is one made before by :func:`seasonal_spread`, where ``df`` holds the ends of series only.

    The last ``season`` rows up to the origin emit their own forecast steps, so nothing
    but those rows and the small spread table is joined.
    """
    require(df, site, time, target, POSITION, LENGTH)
    seasons = math.ceil(horizon / season)
    if spread is None:
        spread = seasonal_spread(_train_rows(df, holdout), seasons, season, target, site, quantiles, chunk_steps)
    origin = last_origin(holdout)
    recent = df.filter((F.col(POSITION) > origin - F.lit(season)) & (F.col(POSITION) <= origin))
    emitted = (
        recent.withColumn(ORIGIN, origin)
        .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(seasons))))
        .withColumn(STEP, F.col(POSITION) - F.col(ORIGIN) + F.col("_k") * F.lit(season))
        .filter(F.col(STEP) <= horizon)
    )
    joined = emitted.join(spread, [site, "_k"], "left")
    return _output(
        joined.withColumns(
            {
                time: _ahead(F.col(time), F.col("_k") * F.lit(season), frequency),
                "q10": F.col(target) + F.col("_lo"),
                "q50": F.col(target) + F.col("_mid"),
                "q90": F.col(target) + F.col("_hi"),
            }
        ),
        site, time,
    )


def climatology_forecast(
    df: DataFrame,
    horizon: int = DECODER_STEPS,
    window_days: int = 30,
    holdout: int = 0,
    frequency: str | int = FREQUENCY,
    tz: str = TIMEZONE,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    quantiles: list[float] = QUANTILES,
) -> DataFrame:
    """Quantiles of the target by series and local hour over the ``window_days`` before
    the origin."""
    require(df, site, time, target, POSITION, LENGTH)
    step = step_micros(frequency)
    recent_steps = window_days * 86_400_000_000 // step
    origin = last_origin(holdout)
    hour = lambda c: calendar(c, tz)["hour"]
    recent = df.filter((F.col(POSITION) <= origin) & (F.col(POSITION) > origin - F.lit(recent_steps)))
    by_hour = grouped_quantiles(
        recent.withColumn("_h", hour(F.col(time))), [site, "_h"], target, quantiles, BANDS
    ).drop("n_obs")
    origins = df.filter(F.col(POSITION) == origin).select(
        site, F.col(POSITION).alias(ORIGIN), F.col(time).alias("_t0")
    )
    steps = origins.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = steps.withColumn(time, _ahead(F.col("_t0"), F.col(STEP), frequency))
    joined = ahead.withColumn("_h", hour(F.col(time))).join(by_hour, [site, "_h"], "left")
    return _output(joined, site, time)


def _train_rows(df: DataFrame, holdout: int) -> DataFrame:
    rows = df.filter(F.col(POSITION) <= last_origin(holdout))
    return rows.filter(F.col(SPLIT) == "train") if SPLIT in df.columns else rows


def _per_series(spread: DataFrame, site: str, key: str) -> DataFrame:
    """A spread table as one row per series: a map from step (or season) to its band."""
    band = F.struct("_lo", "_mid", "_hi")
    return spread.groupBy(site).agg(F.map_from_entries(F.collect_list(F.struct(key, band))).alias("_spread"))


def _spread_bands(base: Column, key: Column) -> list[Column]:
    band = F.try_element_at("_spread", key)
    return [(base + band[s]).alias(b) for s, b in zip(["_lo", "_mid", "_hi"], BANDS)]


def backtest_persistence(
    df: DataFrame,
    horizon: int,
    split: str = "val",
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    frequency: str | int = FREQUENCY,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
    labels_inside: bool = False,
) -> DataFrame:
    """Persistence forecasts from *every* origin whose ``horizon`` rows ahead all exist and
    that lies in ``split``, with the actual ``y``: the input of the evaluation operators.

    Spread and pairs read the same arrays of chunks, written once; the bands of a series meet
    its arrays, and pairs are made of them by a projection and not shuffled. ``labels_inside`` leaves out pairs whose actual
    lies past the split: what is chosen by such scores has not seen the test rows.
    """
    require(df, SPLIT)
    complete = (F.col(SPLIT) == split) & (F.col(POSITION) + F.lit(horizon) < F.col(LENGTH))
    chunks = settled(horizon_chunks(df, horizon, target, site, time, chunk_steps, [SPLIT, LENGTH], complete), "backtest-chunks")
    spread = spread_of_chunks(chunks, horizon, target, site, quantiles, chunk_steps, only="train")
    bands = F.sort_array(F.collect_list(F.struct(STEP, "_lo", "_mid", "_hi")))
    # one place per step, NULL where a step was never seen
    by_step = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: F.get(F.filter("_seen", lambda b: b[STEP] == h), F.lit(0)))
    per_series = spread.groupBy(site).agg(bands.alias("_seen")).withColumn("_all", F.when(F.size("_seen") == horizon, F.col("_seen")).otherwise(by_step))
    per_series = per_series.select(site, *[F.col(f"_all.{c}").alias(c) for c in ("_lo", "_mid", "_hi")])
    pairs = pairs_of(chunks, horizon, target, site, time, label_keep=[SPLIT] if labels_inside else [], series_stats=per_series)
    if labels_inside:
        pairs = pairs.filter(F.col(f"label_{SPLIT}") == split)
    band = lambda c: F.col("y_origin") + F.get(c, F.col(STEP) - 1)
    return pairs.select(
        site, ORIGIN, STEP, _ahead(F.col("origin_ts"), F.col(STEP), frequency).alias(time),
        *[band(c).alias(b) for c, b in zip(["_lo", "_mid", "_hi"], BANDS)], "y",
    )


def backtest_seasonal(
    df: DataFrame,
    horizon: int,
    season: int,
    split: str = "val",
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    frequency: str | int = FREQUENCY,
    quantiles: list[float] = QUANTILES,
    chunk_steps: int = CHUNK_STEPS,
    labels_inside: bool = False,
) -> DataFrame:
    """As :func:`backtest_persistence` for the seasonal forecast.

    Forecast and actual of target row ``i`` at step ``h`` are ``y[i - k * season]`` with
    ``k = ceil(h / season)`` and ``y[i]``: lags of the *target* row, which then emits its
    origins. Needs one season of rows before the origin.
    """
    require(df, SPLIT)
    seasons = math.ceil(horizon / season)
    spread = seasonal_spread(
        df.filter(F.col(SPLIT) == "train"), seasons, season, target, site, quantiles, chunk_steps
    )
    back = season * seasons
    chunked = with_halo(
        df.select(site, time, POSITION, LENGTH, SPLIT, target), site, POSITION,
        back=max(back, horizon), chunk_steps=max(chunk_steps, back, horizon),
        series_stats=_per_series(spread, site, "_k"),
    )
    w = chunk_window(site, POSITION)
    lags = F.array(*[F.lag(target, season * k).over(w) for k in range(1, seasons + 1)])
    origin_splits = F.collect_list(F.struct(POSITION, SPLIT)).over(w.rowsBetween(-horizon, -1))
    rows = core(chunked.withColumns({"_lags": lags, "_origins": origin_splits}))
    emitted = rows.withColumn("_o", F.explode("_origins"))
    step = F.col(POSITION) - F.col(f"_o.{POSITION}")
    k = floor_div(step + F.lit(season - 1), season).cast("int")
    usable = (
        (F.col(f"_o.{SPLIT}") == split)
        & (F.col(f"_o.{POSITION}") + F.lit(horizon) < F.col(LENGTH))
        & (F.col(f"_o.{POSITION}") >= season - 1)
    )
    if labels_inside:
        usable = usable & (F.col(SPLIT) == split)
    return emitted.filter(usable).select(
        site, F.col(f"_o.{POSITION}").alias(ORIGIN), step.cast("int").alias(STEP), time,
        *_spread_bands(F.get("_lags", k - 1), k),
        F.col(target).alias("y"),
    )


def attach_actuals(
    forecast: DataFrame, df: DataFrame, target: str = TARGET, site: str = SITE, time: str = TIME
) -> DataFrame:
    """Add ``y`` by series and time, NULL where not (yet) observed."""
    actual = df.select(site, time, F.col(target).alias("y"))
    return forecast.join(actual, [site, time], "left")


def envelope(forecast: DataFrame, bands: list[str] = BANDS, non_crossing: bool = False) -> DataFrame:
    """``lower``, ``median``, ``upper`` of a forecast whose quantiles may cross.

    Lower and upper are the least and greatest of the bands and the median stays as
    forecast; with fewer than three bands the median is theirs. ``non_crossing`` sorts the
    bands instead.
    """
    cols = [F.col(b) for b in bands]
    if len(cols) == 1:
        return forecast.withColumns({n: cols[0] for n in ("lower", "median", "upper")})
    low, high = F.least(*cols), F.greatest(*cols)
    if len(cols) < 3:
        middle = sum(cols[1:], cols[0]) / len(cols)
    else:
        middle = F.sort_array(F.array(*cols))[len(cols) // 2] if non_crossing else cols[1]
    return forecast.withColumns({"lower": low, "median": middle, "upper": high})


def known_future(
    df: DataFrame,
    horizon: int = DECODER_STEPS,
    frequency: str | int = FREQUENCY,
    tz: str = TIMEZONE,
    covariates: DataFrame | None = None,
    site: str = SITE,
    time: str = TIME,
) -> DataFrame:
    """Calendar covariates of the ``horizon`` rows after each series, plus given ones."""
    rows = future_timestamps(df, horizon, frequency, site, time)
    out = rows.withColumns(calendar(F.col(time), tz))
    return out if covariates is None else add_covariates(out, covariates, site, time)


def add_covariates(
    df: DataFrame, covariates: DataFrame, site: str = SITE, time: str = TIME
) -> DataFrame:
    """Left join of covariate columns (rain, planned release) by time, and by series when
    the covariates name one."""
    keys = [time] + ([site] if site in covariates.columns else [])
    return df.join(covariates, keys, "left")


def add_holidays(
    df: DataFrame, holidays: DataFrame, tz: str = TIMEZONE, time: str = TIME, date: str = "date"
) -> DataFrame:
    """``is_holiday`` by local date, from a table of dates the caller gives."""
    days = holidays.select(F.col(date).cast("date").alias("_day")).distinct()
    wall = F.to_date(F.from_utc_timestamp(F.col(time), tz))
    joined = df.withColumn("_local_day", wall).join(
        days.withColumn("is_holiday", F.lit(1)), F.col("_local_day") == F.col("_day"), "left"
    )
    return joined.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0))).drop("_day", "_local_day")


# --- learned direct forecast ---------------------------------------------------------


def learning_rows(
    df: DataFrame,
    horizon: int,
    features: list[str],
    target: str = TARGET,
    frequency: str | int = FREQUENCY,
    tz: str = TIMEZONE,
    site: str = SITE,
    time: str = TIME,
    chunk_steps: int = CHUNK_STEPS,
    origin_filter: Column | None = None,
) -> DataFrame:
    """One row per origin and step: features known at the origin, calendar of the target
    hour, and the label. Nothing after the origin but the calendar enters a feature."""
    extra = [c for c in [SPLIT, LENGTH] if c in df.columns]
    keep = list(dict.fromkeys([*features, *extra]))
    labels = [SPLIT] if SPLIT in df.columns else []
    pairs = horizon_pairs(df, horizon, target, site, time, chunk_steps, keep, origin_filter, labels)
    ts = _ahead(F.col("origin_ts"), F.col(STEP), frequency)
    return _with_target_calendar(pairs.withColumn(time, ts), time, tz)


CALENDAR_FEATURES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "doy_sin", "doy_cos"]


def _with_target_calendar(rows: DataFrame, time: str, tz: str) -> DataFrame:
    cal = calendar(F.col(time), tz)
    return rows.withColumns({f"target_{c}": cal[c] for c in CALENDAR_FEATURES})


class DirectForecaster:
    """One regressor for all series and steps, with split-conformal bands.

    ``fit`` trains on pairs whose origin and label are both train rows and takes the band
    offsets from residual quantiles per step on pairs inside the validation rows. A row that
    misses a feature gets NULL bands. ``save`` and ``load`` keep the model and the offsets.
    The fit is Spark ML's: linear regression sums one small Gram matrix over all executors.
    """

    def __init__(
        self,
        features: list[str],
        horizon: int = DECODER_STEPS,
        estimator=None,
        target: str = TARGET,
        frequency: str | int = FREQUENCY,
        tz: str = TIMEZONE,
        quantiles: list[float] = QUANTILES,
        site: str = SITE,
        time: str = TIME,
        chunk_steps: int = CHUNK_STEPS,
    ):
        self.features, self.horizon, self.estimator = list(features), horizon, estimator
        self.target, self.frequency, self.tz = target, frequency, tz
        self.quantiles, self.site, self.time = quantiles, site, time
        self.chunk_steps = chunk_steps
        self.model = None
        self.offsets = None

    def _rows(self, df: DataFrame, origin_filter: Column) -> DataFrame:
        return learning_rows(
            df, self.horizon, self.features, self.target, self.frequency, self.tz,
            self.site, self.time, self.chunk_steps, origin_filter,
        )

    def fit(self, df: DataFrame) -> DirectForecaster:
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import LinearRegression

        require(df, SPLIT, POSITION, LENGTH, *self.features)
        inputs = ["y_origin", STEP, *self.features, *[f"target_{c}" for c in CALENDAR_FEATURES]]
        assembler = VectorAssembler(inputCols=inputs, outputCol="_x", handleInvalid="skip")
        regressor = self.estimator or LinearRegression(solver="normal", regParam=1e-6)
        regressor = regressor.copy()
        regressor.setFeaturesCol("_x").setLabelCol("y").setPredictionCol("_pred")
        # A train label must itself be a train row: origins near the cut would read past it.
        rows = self._rows(df, F.col(SPLIT) == "train").filter(F.col(f"label_{SPLIT}") == "train")
        self.model = Pipeline(stages=[assembler, regressor]).fit(rows.filter(F.col("y").isNotNull()))
        self.model.stages[0].setHandleInvalid("keep")  # predicting keeps every row
        # nor may a validation label lie in the test rows
        held_out = self._rows(df, F.col(SPLIT) == "val").filter(F.col(f"label_{SPLIT}") == "val")
        residual = self._predict(held_out).withColumn("_r", F.col("y") - F.col("_pred"))
        self.offsets = grouped_quantiles(
            residual, [STEP], "_r", [self.quantiles[0], self.quantiles[-1]], ["_lo", "_hi"]
        ).drop("n_obs")
        # at most `horizon` rows; written, so that no later call expands the pairs again
        path = scratch_path(df.sparkSession, "offsets")
        self.offsets.write.parquet(path)
        self.offsets = df.sparkSession.read.parquet(path)
        return self

    def save(self, path: str) -> None:
        """Model and band offsets under ``path``."""
        self.model.write().overwrite().save(f"{path}/model")
        self.offsets.write.mode("overwrite").parquet(f"{path}/offsets")

    def load(self, spark: SparkSession, path: str) -> DirectForecaster:
        """Model and offsets as saved; the other settings are those of this object."""
        from pyspark.ml import PipelineModel

        self.model = PipelineModel.load(f"{path}/model")
        self.model.stages[0].setHandleInvalid("keep")
        self.offsets = spark.read.parquet(f"{path}/offsets")
        return self

    def _predict(self, rows: DataFrame) -> DataFrame:
        """Rows with ``_pred``; NULL where a feature is missing."""
        out = self.model.transform(rows)
        return out.withColumn("_pred", F.when(~F.isnan("_pred"), F.col("_pred")))

    def _bands(self, predicted: DataFrame) -> DataFrame:
        joined = predicted.join(self.offsets, STEP, "left")
        return joined.withColumns(
            {
                "q10": F.col("_pred") + F.col("_lo"),
                "q50": F.col("_pred"),
                "q90": F.col("_pred") + F.col("_hi"),
            }
        )

    def backtest(self, df: DataFrame, split: str = "test") -> DataFrame:
        """Forecasts with actuals from every complete origin in ``split``."""
        complete = (F.col(SPLIT) == split) & (F.col(POSITION) + F.lit(self.horizon) < F.col(LENGTH))
        out = self._bands(self._predict(self._rows(df, complete)))
        return out.select(self.site, ORIGIN, STEP, self.time, *BANDS, "y")

    def forecast(self, df: DataFrame, holdout: int = 0) -> DataFrame:
        """Forecast from the last row of every series less ``holdout``."""
        origins = df.filter(F.col(POSITION) == last_origin(holdout)).select(
            self.site, F.col(POSITION).alias(ORIGIN), F.col(self.time).alias("origin_ts"),
            F.col(self.target).alias("y_origin"), *self.features,
        )
        steps = origins.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(self.horizon))))
        rows = steps.withColumn(self.time, _ahead(F.col("origin_ts"), F.col(STEP), self.frequency))
        out = self._bands(self._predict(_with_target_calendar(rows, self.time, self.tz)))
        return _output(out, self.site, self.time)


def select_model(scored: DataFrame, model: str = "model", quantiles: list[float] = QUANTILES) -> DataFrame:
    """The candidate with the lowest mean pinball loss, over rows ``(model, y, q10..q90)``."""
    from brimline.operators.evaluate import mean_pinball

    losses = scored.groupBy(model).agg(mean_pinball(quantiles).alias("loss"))
    return losses.agg(F.min_by(model, "loss").alias(model), F.min("loss").alias("loss"))
