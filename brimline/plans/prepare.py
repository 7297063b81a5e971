"""The preparation every later job starts from, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from brimline.operators.features import add_calendar, look_back, with_lags_rollings
from brimline.operators.grid import FILL_LIMIT, MAX_GRID_STEPS, regularize_chunks
from brimline.operators.split import split_by_ratio
from brimline.plans.chunks import CHUNK_STEPS, chunk_window, core
from brimline.schema import (
    FREQUENCY,
    LAGS,
    ROLL_STATS,
    ROLL_WINDOWS,
    SITE,
    TARGET,
    TIME,
    TIMEZONE,
    TRAIN_RATIO,
    VAL_RATIO,
)


def prepare(
    df: DataFrame,
    target: str = TARGET,
    frequency: str | int = FREQUENCY,
    tz: str = TIMEZONE,
    lags: list[int] = LAGS,
    windows: list[int] = ROLL_WINDOWS,
    stats: list[str] = ROLL_STATS,
    site: str = SITE,
    time: str = TIME,
    limit: int = FILL_LIMIT,
    chunk_steps: int = CHUNK_STEPS,
    max_steps: int = MAX_GRID_STEPS,
) -> DataFrame:
    """Regular grid, gap fill, calendar, lags and rolling statistics of a panel.

    The grid's shuffle by ``(site, chunk)`` already brings the look-back rows, so the
    feature windows run on it without a second shuffle. The result is narrow work away
    from split, scaling and windowing; write it once and start those from the table.
    """
    back = look_back(lags, windows)
    steps = max(chunk_steps, back)
    chunked = regularize_chunks(df, frequency, site, time, True, limit, steps, max_steps, halo=back)
    w = chunk_window(site, time)
    featured = with_lags_rollings(chunked, target, lags, windows, stats, w)
    return add_calendar(core(featured), time, tz)


def prepare_splits(
    df: DataFrame,
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
    **options,
) -> DataFrame:
    """:func:`prepare` plus a ``split`` column; the split itself needs no shuffle."""
    prepared = prepare(df, **options)
    site, time = options.get("site", SITE), options.get("time", TIME)
    return split_by_ratio(prepared, train_ratio, val_ratio, site, time)
