"""Linear quantile forecasts of all series and steps, fitted by reweighted normal equations."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.functions.time import from_micros, micros, step_micros
from brimline.operators.forecast import BANDS, CALENDAR_FEATURES, _with_target_calendar, last_origin
from brimline.operators.split import SPLIT
from brimline.operators.windows import ORIGIN, STEP, horizon_chunks, pairs_of
from brimline.plans.chunks import CHUNK_STEPS
from brimline.schema import DECODER_STEPS, FREQUENCY, LENGTH, POSITION, QUANTILES, SITE, TARGET, TIME, TIMEZONE, require
from brimline.session import settled

ITERATIONS = 8
#: The least residual a weight is taken from, as a share of the mean one of the first fit.
FLOOR_SHARE = 0.05


def solved(sums: dict[str, float], width: int) -> np.ndarray:
    """Coefficients from the sums of a weighted Gram matrix; least norm where it is singular."""
    gram, right = np.zeros((width, width)), np.zeros(width)
    for i in range(width):
        right[i] = sums[f"r_{i}"] or 0.0
        for j in range(i, width):
            gram[i, j] = gram[j, i] = sums[f"g_{i}_{j}"] or 0.0
    size = np.sqrt(np.maximum(np.diag(gram), 1e-300))  # inputs of any unit count alike
    return np.linalg.lstsq(gram / np.outer(size, size), right / size, rcond=1e-12)[0] / size


class QuantileForecaster:
    """One linear model per quantile over pairs of origin and step.

    Inputs are the origin's target and step, ``features`` at the origin, ``known`` columns at
    the target hour (forecasts of rain, planned release) and its calendar; ``inputs`` names
    others. Each pass sums one weighted Gram matrix per quantile over all executors, weights
    being ``|q - (r < 0)| / max(|r|, floor)`` of the residuals before; the driver holds a few
    numbers. Pairs whose origin and label are both train rows are used, and are read out of
    written chunk arrays in every pass, never shuffled. Pairs that lack an input are left out,
    and forecasts that lack one have NULL bands.
    """

    def __init__(
        self, features: list[str] = (), horizon: int = DECODER_STEPS, known: list[str] = (), inputs: list[str] | None = None,
        target: str = TARGET, frequency: str | int = FREQUENCY, tz: str = TIMEZONE, quantiles: list[float] = QUANTILES,
        site: str = SITE, time: str = TIME, chunk_steps: int = CHUNK_STEPS, iterations: int = ITERATIONS,
    ):
        self.features, self.known, self.horizon = list(features), list(known), horizon
        self.inputs = list(inputs) if inputs is not None else [
            "y_origin", STEP, *self.features, *[f"label_{c}" for c in self.known], *[f"target_{c}" for c in CALENDAR_FEATURES],
        ]
        self.target, self.frequency, self.tz, self.quantiles = target, frequency, tz, [float(q) for q in quantiles]
        self.site, self.time, self.chunk_steps, self.iterations = site, time, chunk_steps, iterations
        self.coefficients: np.ndarray | None = None  # quantiles by (1, inputs)

    # --- fitting

    def _chunks(self, df: DataFrame, origins: Column) -> DataFrame:
        keep = list(dict.fromkeys([SPLIT, LENGTH, *self.features, *self.known]))
        return settled(horizon_chunks(df, self.horizon, self.target, self.site, self.time, self.chunk_steps, keep, origins), "learning-chunks")

    def _pairs(self, chunks: DataFrame) -> DataFrame:
        pairs = pairs_of(chunks, self.horizon, self.target, self.site, self.time, self.features, [SPLIT, *self.known])
        ahead = from_micros(micros(F.col("origin_ts")) + F.col(STEP) * F.lit(step_micros(self.frequency)))
        return _with_target_calendar(pairs.withColumn(self.time, ahead), self.time, self.tz)

    def _x(self) -> list[Column]:
        return [F.lit(1.0), *[F.col(c).cast("double") for c in self.inputs]]

    def _predicted(self, coefficients: np.ndarray) -> Column:
        terms = [F.lit(float(b)) * x for b, x in zip(coefficients, self._x())]
        return sum(terms[1:], terms[0])

    def fit(self, df: DataFrame) -> QuantileForecaster:
        require(df, SPLIT, POSITION, LENGTH, *self.features, *self.known)
        rows = self._pairs(self._chunks(df, F.col(SPLIT) == "train")).filter(F.col(f"label_{SPLIT}") == "train")
        rows = rows.dropna(subset=["y", *self.inputs])
        x, width = self._x(), len(self.inputs) + 1

        def sums(weight: Column, name: str) -> list[Column]:
            out = [F.sum(weight * x[i] * x[j]).alias(f"{name}g_{i}_{j}") for i in range(width) for j in range(i, width)]
            return out + [F.sum(weight * x[i] * F.col("y")).alias(f"{name}r_{i}") for i in range(width)]

        first = rows.agg(*sums(F.lit(1.0), ""), F.count(F.lit(1)).alias("n")).first().asDict()
        if not first["n"]:
            raise ValueError("no pair of train rows has all inputs")
        now = np.tile(solved(first, width), (len(self.quantiles), 1))
        floor = FLOOR_SHARE * (rows.agg(F.avg(F.abs(F.col("y") - self._predicted(now[0])))).first()[0] or 0.0)
        for _ in range(self.iterations if floor > 0 else 0):
            aggs = []
            for k, q in enumerate(self.quantiles):
                r = F.col("y") - self._predicted(now[k])
                side = F.when(r < 0, F.lit(1.0 - q)).otherwise(F.lit(q))
                aggs += sums(side / F.greatest(F.abs(r), F.lit(floor)), f"q{k}_")
            found = rows.agg(*aggs).first().asDict()
            now = np.stack([solved({n.removeprefix(f"q{k}_"): v for n, v in found.items() if n.startswith(f"q{k}_")}, width)
                            for k in range(len(self.quantiles))])
        self.coefficients = now
        return self

    # --- keeping

    SETTINGS = ("features", "known", "horizon", "inputs", "target", "frequency", "tz", "quantiles", "site", "time", "chunk_steps", "iterations")

    def save(self, spark: SparkSession, path: str) -> None:
        """Settings and coefficients as one JSON line under ``path``."""
        kept = {k: getattr(self, k) for k in self.SETTINGS}
        kept["coefficients"] = self.coefficients.tolist()
        spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> QuantileForecaster:
        """The forecaster as it was saved, settings included."""
        kept = json.loads(spark.read.text(path).first()[0])
        coefficients = np.array(kept.pop("coefficients"))
        out = cls(**kept)
        out.coefficients = coefficients
        return out

    # --- forecasting

    def _bands(self) -> list[Column]:
        return [self._predicted(b).alias(n) for b, n in zip(self.coefficients, BANDS)]

    def forecast(self, df: DataFrame, holdout: int = 0, future: DataFrame | None = None) -> DataFrame:
        """Forecast from the last row of every series less ``holdout``. ``known`` columns come from
        ``future`` by series and time, or from the rows held out."""
        at = last_origin(holdout)
        origins = df.filter(F.col(POSITION) == at).select(
            self.site, F.col(POSITION).alias(ORIGIN), F.col(self.time).alias("origin_ts"), F.col(self.target).alias("y_origin"), *self.features
        )
        rows = origins.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(self.horizon))))
        ahead = from_micros(micros(F.col("origin_ts")) + F.col(STEP) * F.lit(step_micros(self.frequency)))
        rows = rows.withColumn(self.time, ahead)
        if self.known:
            given = future if future is not None else df.filter(F.col(POSITION) > at)
            rows = rows.join(given.select(self.site, self.time, *[F.col(c).alias(f"label_{c}") for c in self.known]), [self.site, self.time], "left")
        rows = _with_target_calendar(rows, self.time, self.tz)
        return rows.select(self.site, ORIGIN, STEP, self.time, *self._bands())

    def backtest(self, df: DataFrame, split: str = "test", labels_inside: bool = False) -> DataFrame:
        """Forecasts with actuals from every complete origin in ``split``, as of the other models;
        ``labels_inside`` leaves out pairs whose actual lies past the split."""
        complete = (F.col(SPLIT) == split) & (F.col(POSITION) + F.lit(self.horizon) < F.col(LENGTH))
        pairs = self._pairs(self._chunks(df, complete))
        if labels_inside:
            pairs = pairs.filter(F.col(f"label_{SPLIT}") == split)
        return pairs.select(self.site, ORIGIN, STEP, self.time, *self._bands(), "y")
