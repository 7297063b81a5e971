"""Covariates as they were known: as-of joins, and forecasts by the time they were issued."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.functions.time import from_micros, micros, step_micros
from brimline.operators.features import fill_features
from brimline.operators.forecast import future_timestamps
from brimline.operators.windows import STEP, horizon_pairs
from brimline.plans.chunks import CHUNK_STEPS
from brimline.schema import DECODER_STEPS, FREQUENCY, SITE, TARGET, TIME, require

ISSUED = "issued"


def as_of(
    df: DataFrame, given: DataFrame, columns: list[str], site: str = SITE, time: str = TIME,
    given_time: str | None = None, chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Each row with the ``columns`` of the last row of ``given`` of its site at or before its
    time; NULL where there is none. Of rows given for one instant one is taken.

    Both sides go through one order by site and time, in which the given rows are carried
    forward over bounded chunks, so neither a long series nor a long gap meets in one task.
    """
    given_time = given_time or time
    require(df, site, time)
    require(given, site, given_time, *columns)
    at = lambda c, last: micros(F.col(c)) * 2 + F.lit(last)
    # a given row comes first at its instant
    mine = df.select(site, at(time, 1).alias("_at"), F.struct(*df.columns).alias("_row"))
    theirs = given.filter(F.col(given_time).isNotNull()).select(site, at(given_time, 0).alias("_at"), F.struct(*columns).alias("_given"))
    both = mine.unionByName(theirs, allowMissingColumns=True)
    carried = fill_features(both, ["_given"], site, "_at", backward=False, chunk_steps=chunk_steps)
    kept = [c for c in df.columns if c not in columns]
    return carried.filter(F.col("_row").isNotNull()).select(*[F.col(f"_row.{c}").alias(c) for c in kept], *[F.col(f"_given.{c}").alias(c) for c in columns])


def issues_by_time(
    issued: DataFrame, columns: list[str], horizon: int, frequency: str | int = FREQUENCY,
    site: str = SITE, time: str = TIME, issue_time: str = ISSUED,
) -> DataFrame:
    """``_issues`` per series and valid time: what was issued for it, in order of issue.

    Only what a forecast of up to ``horizon`` steps may see stays: the last issue before the
    horizon begins, and those after it up to the valid time.
    """
    require(issued, site, time, issue_time, *columns)
    begin = from_micros(micros(F.col(time)) - F.lit(horizon * step_micros(frequency)))
    early = F.col(issue_time) <= begin
    item = F.struct(F.col(issue_time).alias("at"), *columns)
    rows = issued.filter(F.col(issue_time) <= F.col(time))
    before = F.array_compact(F.array(F.max(F.when(early, item))))
    within = F.sort_array(F.collect_list(F.when(~early, item)))
    return rows.groupBy(site, time).agg(F.concat(before, within).alias("_issues"))


def issue_known(issues: Column, origin: Column) -> Column:
    """Of an array of issues the last one at or before the origin."""
    return F.array_max(F.filter(issues, lambda x: x["at"] <= origin))


def training_covariates(
    df: DataFrame, issued: DataFrame, columns: list[str], horizon: int = DECODER_STEPS, target: str = TARGET,
    frequency: str | int = FREQUENCY, site: str = SITE, time: str = TIME, issue_time: str = ISSUED,
    origin_filter: Column | None = None, keep: list[str] = (), chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """Pairs of origin and step with the covariates of the target hour as issued at or before
    the origin, and ``issued_at``.

    The issues meet each row of the panel once, by its own time; a pair then looks into the
    array of its target row, so pairs are not shuffled.
    """
    issues = issues_by_time(issued, columns, horizon, frequency, site, time, issue_time)
    rows = df.join(issues, [site, time], "left")
    pairs = horizon_pairs(rows, horizon, target, site, time, chunk_steps, keep, origin_filter, ["_issues"])
    return _opened(pairs.withColumn("_known", issue_known(F.col("label__issues"), F.col("origin_ts"))), columns).drop("label__issues")


def inference_covariates(
    df: DataFrame, issued: DataFrame, columns: list[str], horizon: int = DECODER_STEPS,
    frequency: str | int = FREQUENCY, site: str = SITE, time: str = TIME, issue_time: str = ISSUED,
) -> DataFrame:
    """The ``horizon`` steps after the last row of each series with the covariates as issued at
    or before that row, and ``issued_at``."""
    step = step_micros(frequency)
    rows = future_timestamps(df, horizon, frequency, site, time)
    rows = rows.withColumn("origin_ts", from_micros(micros(F.col(time)) - F.col(STEP) * F.lit(step)))
    issues = issues_by_time(issued, columns, horizon, frequency, site, time, issue_time)
    joined = rows.join(issues, [site, time], "left")
    return _opened(joined.withColumn("_known", issue_known(F.col("_issues"), F.col("origin_ts"))), columns).drop("_issues")


def _opened(rows: DataFrame, columns: list[str]) -> DataFrame:
    opened = {"issued_at": F.col("_known.at"), **{c: F.col(f"_known.{c}") for c in columns}}
    return rows.withColumns(opened).drop("_known")
