"""Covariates as known, answers to requests, the linear quantile model, moments, bounds."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.operators import covariates as cv
from brimline.operators import forecast as fc
from brimline.operators.grid import regularize
from brimline.operators.quantile_model import QuantileForecaster
from brimline.operators.split import apply_scalers, fit_moments, fit_scalers, scalers_of, split_by_ratio, unscale
from brimline.operators.windows import cutoff_of_bounds, training_cutoff
from brimline.plans.request import answer_request, recent

TARGET = "muc_thuong_luu"


def hours(n, start="2025-01-01"):
    return pd.date_range(start, periods=n, freq="h")


@pytest.mark.parametrize("chunk_steps", [5, 4000])
def test_as_of_by_loop(spark, chunk_steps):
    r = np.random.default_rng(0)
    base = pd.Timestamp("2025-01-01")
    rows = pd.DataFrame({"site_id": r.choice(["a", "b", "c"], 120), "timestamp": base + pd.to_timedelta(r.integers(0, 300, 120), "min"), "i": range(120), "v": "mine"})
    given = pd.DataFrame({"site_id": r.choice(["a", "b", "z"], 30), "at": base + pd.to_timedelta(r.choice(500, 30, False), "min"), "v": r.integers(0, 99, 30).astype(float)})
    given.loc[:4, "v"] = np.nan
    g = spark.createDataFrame(given).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    out = cv.as_of(spark.createDataFrame(rows), g, ["v"], given_time="at", chunk_steps=chunk_steps)
    assert out.columns == ["site_id", "timestamp", "i", "v"]
    got = {x.i: x.v for x in out.collect()}
    for x in rows.itertuples():
        seen = given[(given.site_id == x.site_id) & (given["at"] <= x.timestamp)].sort_values("at")
        want = None if seen.empty or np.isnan(seen.v.iloc[-1]) else seen.v.iloc[-1]  # a NULL that was given stays one
        assert got[x.i] == want
    assert len(got) == 120


def test_nothing_issued_after_the_origin(spark):
    t = hours(60)
    panel = regularize(spark.createDataFrame(pd.concat([pd.DataFrame({"site_id": s, "timestamp": t, TARGET: np.arange(60.0)}) for s in "xy"])))
    issued = [("x", v, v - pd.Timedelta(hours=lead), float(lead)) for v in hours(80) for lead in (0, 3, 7, 30)]
    frame = spark.createDataFrame(pd.DataFrame(issued, columns=["site_id", "timestamp", "issued", "rain"]))
    rows = cv.training_covariates(panel, frame, ["rain"], 12, chunk_steps=13).collect()
    assert len(rows) == 2 * sum(min(12, 59 - i) for i in range(60))
    for r in rows:
        if r.site_id == "y":
            assert r.rain is None and r.issued_at is None
        else:
            want = min(lead for lead in (0, 3, 7, 30) if lead >= r.step)
            assert r.rain == want and r.issued_at <= r.origin_ts
    ahead = cv.inference_covariates(panel, frame, ["rain"], 12).filter("site_id = 'x'").collect()
    assert {(r.step, r.rain) for r in ahead} == {(h, min(x for x in (3, 7, 30) if x >= h)) for h in range(1, 13)}


def request_panel(spark, n=400):
    r = np.random.default_rng(1)
    parts = []
    for i in range(3):
        y = np.round(10 * np.sin(np.arange(n) / 24 * 2 * np.pi) + r.normal(size=n) + i, 3)
        y[r.random(n) < 0.1] = np.nan
        parts.append(pd.DataFrame({"site_id": f"s{i}", "timestamp": hours(n), TARGET: y}).iloc[: n - 7 * i])
    return spark.createDataFrame(pd.concat(parts)).withColumn(TARGET, F.when(~F.isnan(TARGET), F.col(TARGET)))


def test_request_equals_the_full_path(spark):
    panel = request_panel(spark)
    full = split_by_ratio(regularize(panel))
    stats = fit_scalers(full.filter("split = 'train'").select(TARGET))
    spread = fc.seasonal_spread(apply_scalers(full.filter("split = 'train'"), stats), 2, 24)
    future = fc.future_timestamps(panel, 48).select("site_id", "timestamp", F.lit(1.0).alias("rain_forecast_mm"))
    seen = {}

    def answer(past, ahead):
        seen["past"], seen["ahead"] = past.count(), ahead.filter("rain_forecast_mm = 1").count()
        return fc.seasonal_forecast(past, 24, 48, spread=spread)

    keys = ["site_id", "step", "timestamp", "q10", "q50", "q90"]
    got = answer_request(panel, future, stats, answer, 24, lags=[1], windows=[3]).select(*keys).toPandas().sort_values(keys[:2])
    want = unscale(fc.seasonal_forecast(apply_scalers(full, stats), 24, 48), stats, fc.BANDS).select(*keys).toPandas().sort_values(keys[:2])
    assert (got[keys[:3]].to_numpy() == want[keys[:3]].to_numpy()).all() and np.allclose(got[keys[3:]], want[keys[3:]])
    assert seen["past"] < 3 * 140 < full.count() and seen["ahead"] == 3 * 48


def test_recent_rows(spark):
    panel = request_panel(spark)
    got = {r.site_id: (r.n, r.b) for r in recent(panel, 10).groupBy("site_id").agg(F.count("*").alias("n"), F.max("timestamp").alias("b")).collect()}
    assert {s: n for s, (n, _) in got.items()} == {"s0": 11, "s1": 11, "s2": 11} and recent(panel.limit(0), 5).count() == 0


def test_quantile_model_learns_and_keeps(spark, tmp_path):
    r = np.random.default_rng(3)
    n = 900
    rain = r.gamma(2.0, 1.0, n)
    y = 3.0 + 2.0 * rain + r.exponential(1.0, n)  # quantiles of the noise: -ln(1 - q)
    df = spark.createDataFrame(pd.DataFrame({"site_id": "s", "timestamp": hours(n), TARGET: y, "rain": rain}))
    df = split_by_ratio(regularize(df))
    model = QuantileForecaster([], 3, ["rain"], ["label_rain"], iterations=25).fit(df)
    for q, (b0, b1) in zip((0.1, 0.5, 0.9), model.coefficients):
        assert b1 == pytest.approx(2.0, abs=0.15) and b0 == pytest.approx(3 - np.log(1 - q), abs=0.25)
    scored = model.backtest(df, "test").filter("y IS NOT NULL")
    below = scored.agg(*[F.avg((F.col("y") <= F.col(b)).cast("double")) for b in fc.BANDS]).first()
    assert [*below] == pytest.approx([0.1, 0.5, 0.9], abs=0.1)
    model.save(spark, str(tmp_path / "m"))
    again = QuantileForecaster.load(spark, str(tmp_path / "m"))
    a, b = (m.forecast(df, holdout=3).orderBy("step").collect() for m in (model, again))
    assert a == b and len(a) == 3 and all(x.q10 < x.q50 < x.q90 for x in a)
    ahead = fc.future_timestamps(df, 3).select("site_id", "timestamp", F.lit(5.0).alias("rain"))
    assert all(x.q50 == pytest.approx(13 + np.log(2), abs=0.8) for x in again.forecast(df, future=ahead).collect())
    assert all(x.q50 is None for x in again.forecast(df, future=ahead.limit(0)).collect())
    full = QuantileForecaster([], 3, ["rain"], iterations=2).fit(df)
    assert full.forecast(df, holdout=3).filter("q50 IS NULL").count() == 0
    with pytest.raises(ValueError):
        QuantileForecaster([], 3).fit(df.filter("split = 'val'"))


def test_moments_of_parts_equal_the_whole(spark):
    panel = request_panel(spark).withColumn("xa_tran", F.lit(7.0)).withColumn("part", F.weekofyear("timestamp"))
    panel = panel.withColumn(TARGET, F.col(TARGET) + 1e6).withColumn("luu_luong_den", F.lit(None).cast("double"))
    want = {r.column: r for r in fit_scalers(panel).collect()}
    got = {r.column: r for r in scalers_of(fit_moments(panel, "part")).collect()}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c].mean == pytest.approx(want[c].mean, abs=1e-9, nan_ok=True) if want[c].mean is not None else got[c].mean is None
        assert got[c].scale == pytest.approx(want[c].scale, rel=1e-9) if want[c].scale is not None else got[c].scale is None


def test_cutoff_before_the_grid(spark):
    panel = request_panel(spark)
    for frequency in ("1H", "2H"):
        assert cutoff_of_bounds(panel, 9, frequency).first() == training_cutoff(regularize(panel, frequency), 9).first()
