"""Answering a request for forecasts from the end of each series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brimline.functions.time import from_micros, micros, step_micros
from brimline.operators.features import add_calendar, with_lags_rollings
from brimline.operators.forecast import BANDS
from brimline.operators.grid import FILL_LIMIT, regularize
from brimline.operators.split import apply_scalers, unscale
from brimline.operators.windows import inference_frame, mark_future
from brimline.plans.chunks import CHUNK_STEPS, chunk_window, core, with_halo
from brimline.schema import FREQUENCY, LENGTH, POSITION, SITE, TARGET, TIME, TIMEZONE, require


def recent(
    history: DataFrame, steps: int, frequency: str | int = FREQUENCY, site: str = SITE, time: str = TIME
) -> DataFrame:
    """The rows of each series within ``steps`` of its last one.

    The ends of all series are one small row each; a row that is older goes before anything
    is shuffled, where Spark sends the ends to the rows, and else in the join.
    """
    require(history, site, time)
    ends = history.groupBy(F.col(site).alias("_site")).agg(F.max(time).alias("_end"))
    begin = from_micros(micros(F.col("_end")) - F.lit(steps * step_micros(frequency)))
    return history.join(ends.withColumn("_begin", begin), F.col(site).eqNullSafe(F.col("_site"))).filter(
        F.col(time) >= F.col("_begin")
    ).drop("_site", "_end", "_begin")


def answer_request(
    history: DataFrame,
    future: DataFrame,
    stats: DataFrame,
    forecast: Callable[[DataFrame, DataFrame], DataFrame],
    look_back: int,
    lags: list[int] = (),
    windows: list[int] = (),
    frequency: str | int = FREQUENCY,
    tz: str = TIMEZONE,
    target: str = TARGET,
    site: str = SITE,
    time: str = TIME,
    limit: int = FILL_LIMIT,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """History and known-future rows to forecasts in the units of the target.

    ``forecast(past, ahead)`` gets prepared, scaled rows: the regular, featured rows up to the
    last known one of each series, with positions, and the rows after it with calendar and the
    given covariates. It returns bands per series, step and time. ``stats`` are the scalers of
    the training. Only ``look_back`` steps, what the features look back on, and twice the fill
    limit before them are read of each series; what a gap longer than that hides stays hidden.
    """
    back = look_back + max([0, *lags, *windows]) + 2 * limit
    frame = inference_frame(recent(history, back, frequency, site, time), future)
    rows = mark_future(regularize(frame, frequency, site, time, limit=limit), site, time, chunk_steps)
    if lags or windows:
        chunked = with_halo(rows, site, POSITION, back=max([*lags, *windows]), chunk_steps=chunk_steps)
        rows = core(with_lags_rollings(chunked, target, list(lags), list(windows), ["mean", "std"], chunk_window(site, POSITION)))
    rows = apply_scalers(add_calendar(rows, time, tz), stats)
    past = rows.filter(~F.col("is_future"))
    # the series ends where its history does
    ends = past.groupBy(site).agg((F.max(POSITION) + 1).alias("_len"))
    past = past.join(ends, site).withColumn(LENGTH, F.col("_len")).drop("_len")
    return unscale(forecast(past, rows.filter("is_future")), stats, BANDS, target)
