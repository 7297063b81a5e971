"""Forecast scores over long rows ``(y, q10, q50, q90, step)``.

Rows without an actual are skipped and ``n_scored`` says how many were used (a mean that
met a missing value would otherwise be missing itself).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.functions.stats import global_rank, normal_quantile
from brimline.operators.windows import ORIGIN, STEP
from brimline.schema import QUANTILES, SITE, TIME
from brimline.session import settled

BANDS = ["q10", "q50", "q90"]
HORIZONS = {"24h": 24, "7d": 168, "14d": 336}


def _scored(forecast: DataFrame) -> DataFrame:
    return forecast.filter(F.col("y").isNotNull() & F.col("q50").isNotNull())


def error() -> Column:
    return F.col("y") - F.col("q50")


def width() -> Column:
    return F.col("q90") - F.col("q10")


def inside() -> Column:
    return F.col("y").between(F.col("q10"), F.col("q90")).cast("double")


def pinball(y: Column, predicted: Column, q: float) -> Column:
    e = y - predicted
    return F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e)


def mean_pinball(quantiles: list[float] = QUANTILES, bands: list[str] = BANDS) -> Column:
    terms = [F.avg(pinball(F.col("y"), F.col(b), q)) for b, q in zip(bands, quantiles)]
    return sum(terms[1:], terms[0]) / len(terms)


def metrics(
    forecast: DataFrame, quantiles: list[float] = QUANTILES, horizons: dict[str, int] = HORIZONS
) -> DataFrame:
    """All scores as one row, in one pass.

    Horizon scores are cumulative (steps 1..h, h capped at the longest step). The CRPS
    approximation is twice the mean pinball loss over the quantiles. Each sample has one
    row of step 1, so samples are counted without a distinct.
    """
    e = error()
    aggs = [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, F.col("y") + F.lit(1e-8)))) * 100).alias("mape"),
        (F.avg(inside()) * 100).alias("coverage"),
        F.avg(width()).alias("interval_width"),
        F.stddev_pop(width()).alias("sharpness"),
    ]
    if {SITE, ORIGIN} <= set(forecast.columns):
        windows = F.count_distinct(SITE, ORIGIN)
    else:  # rows that do not say their origin: one first step each
        windows = F.sum(F.when(F.col(STEP) == 1, 1).otherwise(0))
    for name, h in horizons.items():
        early = F.when(F.col(STEP) <= h, e)
        aggs += [F.avg(F.abs(early)).alias(f"mae_{name}"), F.sqrt(F.avg(early * early)).alias(f"rmse_{name}")]
    for band, q in zip(BANDS, quantiles):
        aggs.append(F.avg(pinball(F.col("y"), F.col(band), q)).alias(f"pinball_{band}"))
    aggs += [
        mean_pinball(quantiles).alias("avg_pinball"),
        (F.lit(2.0) * mean_pinball(quantiles)).alias("crps"),
        windows.alias("n_samples"),
        F.max(STEP).alias("horizon_steps"),
        F.count(F.lit(1)).alias("n_scored"),
    ]
    return _scored(forecast).agg(*aggs)


def metrics_by_step(forecast: DataFrame) -> DataFrame:
    """Absolute error, coverage and interval width per forecast step."""
    return _scored(forecast).groupBy(STEP).agg(
        F.avg(F.abs(error())).alias("mae"),
        (F.avg(inside()) * 100).alias("coverage"),
        F.avg(width()).alias("width"),
        F.count(F.lit(1)).alias("n_scored"),
    )


def nested_metrics(row: DataFrame) -> DataFrame:
    """The one row of :func:`metrics` in the nested groups of the JSON report.

    Group and field names are fixed values of the report format.
    """
    names = {
        "overall": {
            "MAE": "mae", "RMSE": "rmse", "MAPE": "mape", "Coverage_80%": "coverage",
            "Interval_Width": "interval_width", "Sharpness": "sharpness",
        },
        "horizon_wise": {
            f"{kind.upper()}_{c.removeprefix('mae_')}": f"{kind}_{c.removeprefix('mae_')}"
            for c in row.columns if c.startswith("mae_") for kind in ("mae", "rmse")
        },
        "quantile_loss": {
            "Pinball_Q10": "pinball_q10", "Pinball_Q50": "pinball_q50",
            "Pinball_Q90": "pinball_q90", "Avg_Pinball": "avg_pinball",
        },
        "metadata": {"n_samples": "n_samples", "horizon_steps": "horizon_steps"},
    }
    return row.select(
        *[
            F.struct(*[F.col(c).alias(label) for label, c in fields.items()]).alias(group)
            for group, fields in names.items()
        ]
    )


def error_histogram(forecast: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins from the least to the greatest error, the last one closed.

    The errors alone are written first: the forecast behind them runs once.
    """
    errors = settled(_scored(forecast).select(error().alias("_e")), "errors")
    span = errors.agg(F.min("_e").alias("_lo"), F.max("_e").alias("_hi"))  # one row
    lo, hi = F.col("_lo"), F.col("_hi")
    # A single value gets bins of width 1/bins around it.
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    high = F.when(lo == hi, hi + 0.5).otherwise(hi)
    edges = span.select(low.alias("_lo"), high.alias("_hi"))
    placed = errors.crossJoin(F.broadcast(edges)).withColumn(
        "bin", F.least(F.width_bucket("_e", lo, hi, F.lit(bins)), F.lit(bins)).cast("int")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    size = (hi - lo) / F.lit(float(bins))
    return every.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * size).alias("bin_from"),
        (lo + F.col("bin") * size).alias("bin_to"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def normal_qq(forecast: DataFrame) -> DataFrame:
    """Ordered errors against normal order-statistic medians (Filliben's estimate)."""
    ranked = global_rank(_scored(forecast).select(error().alias("error")), "error")
    n, i = F.col("n").cast("double"), F.col("rank")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    p = (
        F.when(i == F.col("n"), top)
        .when(i == 1, F.lit(1.0) - top)
        .otherwise((i - 0.3175) / (n + 0.365))
    )
    return ranked.select("rank", normal_quantile(p).alias("theoretical"), "error")


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the Q-Q points and its correlation."""
    return points.agg(
        F.regr_slope("error", "theoretical").alias("slope"),
        F.regr_intercept("error", "theoretical").alias("intercept"),
        F.corr("error", "theoretical").alias("r"),
    )


def error_pairs(forecast: DataFrame) -> DataFrame:
    """Actual, predicted and signed error of every scored row."""
    return _scored(forecast).select(F.col("y").alias("actual"), F.col("q50").alias("predicted"), error().alias("error"))


def pair_limits(forecast: DataFrame) -> DataFrame:
    """Common range of actual and predicted values."""
    return _scored(forecast).agg(
        F.min(F.least("y", "q50")).alias("low"), F.max(F.greatest("y", "q50")).alias("high")
    )


def signed_errors(forecast: DataFrame, keys: list[str], time: str = TIME) -> DataFrame:
    """Median minus actual per timestamp; rows without an actual are dropped."""
    return _scored(forecast).select(*keys, time, (F.col("q50") - F.col("y")).alias("signed_error"))


def uncertainty(enveloped: DataFrame, keys: list[str], time: str = TIME) -> DataFrame:
    """Upper minus lower per timestamp."""
    return enveloped.select(*keys, time, (F.col("upper") - F.col("lower")).alias("uncertainty"))


def uncertainty_summary(rows: DataFrame) -> DataFrame:
    u = F.col("uncertainty")
    return rows.agg(F.avg(u).alias("mean"), F.max(u).alias("max"), F.min(u).alias("min"))
