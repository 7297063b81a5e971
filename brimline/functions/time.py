"""Time expressions: step lengths, grid arithmetic, local calendars, partial stamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
_UNIT_SECONDS = {"s": 1, "min": 60, "t": 60, "h": 3600, "d": 86400, "w": 604800}


def step_micros(frequency: str | int) -> int:
    """Length of one grid step: ``"1H"``, ``"15min"``, ``"1D"`` or a number of seconds."""
    if isinstance(frequency, int):
        if frequency <= 0:
            raise ValueError("frequency must be positive")
        return frequency * MICROS
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", frequency)
    unit = m and _UNIT_SECONDS.get(m.group(2).lower())
    if not unit or m.group(1) == "0":
        raise ValueError(f"not a fixed-length frequency: {frequency!r}")
    return int(m.group(1) or 1) * unit * MICROS


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def floor_div(number: Column, divisor: int) -> Column:
    """Integer division rounding down; exact, unlike a floor of a double quotient."""
    n = F.lit(divisor).cast("bigint")
    return F.call_function("div", number - F.pmod(number, n), n)


def local(ts: Column, tz: str) -> Column:
    """Wall-clock time in ``tz`` of an instant (session time zone must be UTC)."""
    return F.from_utc_timestamp(ts, tz)


def calendar(ts: Column, tz: str) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), day of year, their circular pairs and a weekend flag."""
    wall = local(ts, tz)
    raw = {"hour": F.hour(wall), "dow": F.weekday(wall), "doy": F.dayofyear(wall)}
    period = {"hour": 24, "dow": 7, "doy": 366}
    out = dict(raw)
    for name, value in raw.items():
        angle = F.lit(2.0) * F.pi() * value / F.lit(float(period[name]))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    out["is_weekend"] = (raw["dow"] >= 5).cast("int")
    return out


# Day, month, hour and minute of a stamp without a year; the blank may be missing.
_PARTIAL = (
    r"^(3[01]|[12]\d|0?[1-9])/(1[0-2]|0?[1-9])\s*(2[0-3]|[01]?\d):([0-5]?\d)$"
)


def partial_timestamp(text: Column, year: Column) -> Column:
    """``dd/MM HH:mm`` or ``dd/MMHH:mm`` plus a year -> local timestamp, bad -> NULL.

    The year goes in before parsing, so 29 February survives in leap years and is NULL in
    others (a parse against a fixed non-leap year would lose it always).
    """
    squeezed = F.replace(text, F.lit(" "), F.lit(""))
    stamp = F.when(text.rlike(_PARTIAL), text).when(squeezed.rlike(_PARTIAL), squeezed)
    part = [F.regexp_extract(stamp, _PARTIAL, i).cast("int") for i in range(1, 5)]
    day, month, hour, minute = part
    return F.try_make_timestamp(
        year.cast("int"), month, day, hour, minute, F.lit(0).cast("decimal(16,6)")
    )


def year_from_name(name: Column) -> Column:
    """Year in a file name: before a month first, else any ``20xx``; NULL when none."""
    # The patterns of a year in a file name.
    with_month = F.regexp_extract(name, r"(20[0-9]{2})[-_]?[0-9]{2}", 1)
    alone = F.regexp_extract(name, r"(20[0-9]{2})", 1)
    return F.coalesce(F.nullif(with_month, F.lit("")), F.nullif(alone, F.lit(""))).cast("int")
