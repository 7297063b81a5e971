"""Splits, scaling, windows, forecasts, scores."""

import json
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.functions.stats import global_rank, grouped_quantiles, normal_quantile
from brimline.operators import evaluate as ev
from brimline.operators import forecast as fc
from brimline.operators.grid import regularize
from brimline.operators.split import apply_scalers, fit_scalers, split_by_ratio, unscale
from brimline.operators.windows import horizon_pairs, window_arrays, window_rows
from brimline.plans.prepare import prepare_splits
from brimline.operators.profile import profile
from brimline.schema import column_groups, feature_manifest
from brimline.sources import sinks
from brimline.streaming.coverage import coverage_by_month, expected_polls, missing_polls


def hourly(spark, lengths, seed=0, y=None):
    rng = np.random.default_rng(seed)
    parts = [
        pd.DataFrame({"site_id": f"s{i}", "timestamp": pd.date_range("2025-01-01", periods=n, freq="h"),
                      "muc_thuong_luu": np.arange(n, dtype=float) if y == "ramp" else rng.normal(size=n),
                      "muc_chet": 5.0})
        for i, n in enumerate(lengths)
    ]
    return spark.createDataFrame(pd.concat(parts))


def test_split_and_scale(spark):
    df = split_by_ratio(regularize(hourly(spark, [100], y="ramp")))
    counts = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 70, "val": 15, "test": 15}
    stats = fit_scalers(df.filter("split = 'train'"))
    by = {r.column: r for r in stats.collect()}
    assert by["muc_chet"].scale == 1.0 and by["muc_chet"].mean == 5.0
    assert by["muc_thuong_luu"].scale == pytest.approx(np.arange(70).std())
    scaled = apply_scalers(df, stats)
    train = scaled.filter("split = 'train'").agg(F.avg("muc_thuong_luu"), F.stddev_pop("muc_thuong_luu")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
    back = unscale(scaled, stats, ["muc_thuong_luu"]).orderBy("time_idx").toPandas()
    assert np.allclose(back.muc_thuong_luu, np.arange(100))


def test_groups_and_manifest(spark):
    df = prepare_splits(hourly(spark, [30]), lags=[1], windows=[3])
    groups = column_groups(df)
    assert groups["known"][:2] == ["hour_sin", "hour_cos"] and groups["static_reals"] == ["muc_chet"]
    assert groups["unknown"] == sorted({"muc_thuong_luu", "was_imputed", "muc_thuong_luu_lag_1",
                                        "muc_thuong_luu_rolling_mean_3", "muc_thuong_luu_rolling_std_3"})
    want = feature_manifest(df)
    got = json.loads(sinks.manifest_frame(df).toJSON().first())
    assert got == want and got["features"]["continuous_obs"] == ["muc_thuong_luu", "was_imputed"]


def test_manifest_written_and_read(spark, tmp_path):
    df = prepare_splits(hourly(spark, [30]), lags=[1], windows=[3])
    path = sinks.write_manifest(df, str(tmp_path / "manifest"), enc_len=12)
    got = sinks.read_manifest(spark, path)
    assert json.loads(got.toJSON().first()) == feature_manifest(df, enc_len=12)
    rows = [(r.role, r.column, r.enc_len) for r in sinks.manifest_columns(got).collect()]
    want = feature_manifest(df)["features"]
    assert rows == [(role, c, 12) for role, names in want.items() for c in names]


def test_profile_counts_missing_values(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None, "x"), ("a", float("nan"), 4, None), ("b", None, None, "y")], "k string, v double, n long, s string"
    )
    got = {(r.k, r.role, r.column): tuple(r)[3:] for r in profile(df, {"p": ["v", "n"], "q": ["s", "v"]}, ["k"]).collect()}
    assert got["a", "p", "v"] == got["a", "q", "v"] == (1, 1, 1.0, 1.0, 1.0)
    assert got["a", "p", "n"] == (1, 1, 4.0, 4.0, 4.0) and got["a", "q", "s"] == (1, 1, None, None, None)
    assert got["b", "p", "v"] == (0, 1, None, None, None) and len(got) == 8
    assert profile(df.filter("false"), {"p": ["v"]}).first().n_known == 0
    with pytest.raises(ValueError):
        profile(df, {"p": []})


def brute_windows(lengths, enc, dec, keep):
    return {(f"s{i}", o, s) for i, n in enumerate(lengths) for o in range(enc - 1, n - dec) if keep(i, o)
            for s in range(-enc + 1, dec + 1)}


def test_windows(spark):
    lengths, enc, dec = [40, 25, 11, 12], 8, 4
    df = regularize(hourly(spark, lengths), chunk_steps=10)
    cut = max(lengths) - 1 - dec
    sets = {"all": lambda i, o: True, "train": lambda i, o: o + dec <= cut, "validation": lambda i, o: o >= cut,
            "last": lambda i, o: o == lengths[i] - 1 - dec}
    for only, keep in sets.items():
        got = {(r.site_id, r.origin_idx, r.step) for r in window_rows(df, enc, dec, only=only).collect()}
        assert got == brute_windows(lengths, enc, dec, keep), only
    got = {(r.site_id, r.origin_idx, r.step) for r in window_rows(df, enc, dec, stride=3).collect()}
    assert got == brute_windows(lengths, enc, dec, lambda i, o: (o - enc + 1) % 3 == 0)
    arrays = window_arrays(df, ["muc_thuong_luu"], enc, dec, only="last").collect()
    assert {(r.site_id, r.origin_idx) for r in arrays} == {("s0", 35), ("s1", 20), ("s3", 7)}
    assert all([s.step for s in r.encoder] == list(range(-7, 1)) and len(r.decoder) == 4 for r in arrays)


@pytest.mark.parametrize("chunk_steps", [6, 1000])
def test_horizon_pairs(spark, chunk_steps):
    df = regularize(hourly(spark, [30, 7], y="ramp"))
    got = horizon_pairs(df, 5, chunk_steps=chunk_steps).toPandas()
    assert (got.y - got.y_origin == got.step).all() and (got.origin_idx + got.step == got.y).all()
    assert len(got) == sum(min(5, n - 1 - i) for n in (30, 7) for i in range(n))


def test_quantiles_and_rank(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 4000), "v": np.round(rng.normal(size=4000), 2)})
    pdf.loc[:1500, "v"] = 0.0  # a third of all rows are one value
    df = spark.createDataFrame(pdf)
    got = grouped_quantiles(df, ["k"], "v", [0.1, 0.9], ["lo", "hi"]).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        v = np.sort(g.v.to_numpy())
        assert got.lo[k] == v[int(np.ceil(0.1 * len(v))) - 1] and got.hi[k] == v[int(np.ceil(0.9 * len(v))) - 1]
    for buckets in (1, 7):
        r = global_rank(df, "v", buckets=buckets).toPandas().sort_values("rank")
        assert (r["rank"] == np.arange(1, 4001)).all() and (r.n == 4000).all()
        assert (r.v.to_numpy() == np.sort(pdf.v)).all()
    p = [1e-300, 1e-12, 0.001, 0.02, 0.07, 0.3, 0.5, 0.8, 0.999999]
    z = spark.createDataFrame([(x,) for x in p], "p double").select(normal_quantile(F.col("p"))).collect()
    assert [r[0] for r in z] == pytest.approx([NormalDist().inv_cdf(x) for x in p], rel=1e-12, abs=1e-12)


def test_metric_literals(spark):
    rows = [(1, 1.0, 1.1), (2, 2.0, 2.2), (3, 3.0, 2.9), (1, 4.0, 4.1), (2, 5.0, 4.9), (3, 6.0, 6.1), (3, None, 1.0)]
    df = spark.createDataFrame([(s, y, q - 1, q, q + 1) for s, y, q in rows],
                               "step int, y double, q10 double, q50 double, q90 double")
    m = ev.metrics(df).first()
    assert m.mae == pytest.approx(0.11667, abs=1e-5) and m.coverage == 100.0
    assert (m.n_samples, m.n_scored, m.horizon_steps) == (2, 6, 3)
    assert m.mae_24h == m.mae and m.sharpness == pytest.approx(0, abs=1e-9) and m.interval_width == pytest.approx(2)
    one = spark.createDataFrame([(1, 5.0, 4.0)], "step int, y double, q50 double")
    assert one.select(ev.pinball(F.col("y"), F.col("q50"), 0.5)).first()[0] == 0.5
    doc = json.loads(sinks.metrics_json(ev.metrics(df)).first().value)
    assert list(doc) == ["overall", "horizon_wise", "quantile_loss", "metadata"]
    assert doc["overall"]["MAE"] == pytest.approx(m.mae) and doc["metadata"]["n_samples"] == 2
    text = [r.value for r in sinks.metrics_text(ev.metrics(df)).orderBy("line_no").collect()]
    assert text[1] == "  MAE: 0.1167"
    flat = df.withColumns({"q50": F.col("y")})
    hist = ev.error_histogram(flat, 4).orderBy("bin").toPandas()
    assert hist.n.tolist() == [0, 0, 6, 0]


def test_qq_matches_order_statistics(spark):
    errors = np.random.default_rng(5).normal(2, 3, 200)
    df = spark.createDataFrame(pd.DataFrame({"step": 1, "y": errors, "q50": 0.0}))
    got = ev.normal_qq(df).toPandas().sort_values("rank")
    n = len(errors)
    p = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    p[-1] = 0.5 ** (1 / n)
    p[0] = 1 - p[-1]
    want = [NormalDist().inv_cdf(x) for x in p]
    assert np.allclose(got.theoretical, want) and np.allclose(got.error, np.sort(errors))
    slope, intercept = np.polyfit(want, np.sort(errors), 1)
    line = ev.qq_line(ev.normal_qq(df)).first()
    assert (line.slope, line.intercept) == (pytest.approx(slope), pytest.approx(intercept))


def test_envelope(spark):
    df = spark.createDataFrame([(3.0, 9.0, 5.0)], "q10 double, q50 double, q90 double")
    assert fc.envelope(df).select("lower", "median", "upper").first()[:] == (3.0, 9.0, 9.0)
    assert fc.envelope(df, non_crossing=True).first().median == 5.0
    assert fc.envelope(df, ["q10", "q50"]).select("lower", "median", "upper").first()[:] == (3.0, 6.0, 9.0)


@pytest.fixture(scope="module")
def learned(spark):
    rng = np.random.default_rng(8)
    t = np.arange(500)
    y = np.sin(2 * np.pi * t / 24) * 3 + rng.normal(0, 0.1, 500)
    pdf = pd.DataFrame({"site_id": "a", "timestamp": pd.date_range("2024-01-01", periods=500, freq="h"),
                        "muc_thuong_luu": y})
    rows = prepare_splits(spark.createDataFrame(pdf), lags=[1, 24], windows=[24])
    features = ["muc_thuong_luu_lag_1", "muc_thuong_luu_lag_24", "muc_thuong_luu_rolling_mean_24"]
    return pdf, rows, features, fc.DirectForecaster(features, 12).fit(rows)


def test_learned_forecast(spark, learned):
    pdf, rows, features, model = learned
    scored = model.backtest(rows, "test")
    m = ev.metrics(scored).first()
    naive = ev.metrics(fc.backtest_persistence(rows, 12, "test")).first()
    assert m.mae < naive.mae / 3 and 60 < m.coverage <= 100
    out = model.forecast(rows, holdout=12).toPandas()
    assert len(out) == 12 and (out.q10 <= out.q50).all() and (out.q50 <= out.q90).all()
    best = fc.select_model(scored.withColumn("model", F.lit("learned")).unionByName(
        fc.backtest_persistence(rows, 12, "test").withColumn("model", F.lit("naive")))).first()
    assert best.model == "learned"


def test_forecast_does_not_see_the_future(spark, learned):
    pdf, rows, features, model = learned
    changed = pdf.copy()
    changed.loc[488:, "muc_thuong_luu"] = 1e6  # after the origin of a 12-row holdout
    other = prepare_splits(spark.createDataFrame(changed), lags=[1, 24], windows=[24])
    for make in (lambda d: model.forecast(d, 12), lambda d: fc.seasonal_forecast(d, 24, 12, 12),
                 lambda d: fc.persistence_forecast(d, 12, 12), lambda d: fc.climatology_forecast(d, 12, 10, 12)):
        a, b = (make(d).toPandas().sort_values("step") for d in (rows, other))
        assert np.allclose(a[["q10", "q50", "q90"]], b[["q10", "q50", "q90"]])


def test_split_sink(spark, tmp_path):
    df = prepare_splits(hourly(spark, [60, 40]), lags=[1], windows=[3])
    for fmt in ("parquet", "csv"):
        out = sinks.write_splits(df, f"{tmp_path}/{fmt}", fmt, scaled=True)
        raw = spark.read.option("header", True).format(fmt).load(out["raw"])
        assert raw.count() == 100 and set(raw.columns) == set(df.columns)
        assert spark.read.parquet(out["scalers"]).count() == len([c for c in df.columns if c in (
            "muc_thuong_luu", "was_imputed", "muc_chet", "is_weekend") or c.endswith(("_sin", "_cos"))])
        assert spark.read.option("header", True).format(fmt).load(out["scaled"]).count() == 100


def test_poll_coverage(spark):
    expected = expected_polls(spark, "2024-01-31 22:00:00", "2024-02-01 02:00:00", "2H")
    received = expected.filter("hour(poll_time) = 0")
    assert {str(r.poll_time) for r in missing_polls(expected, received).collect()} == {
        "2024-01-31 22:00:00", "2024-02-01 02:00:00"}
    got = {r.month: (r.expected, r.received, r.missing) for r in coverage_by_month(expected, received).collect()}
    assert got == {"2024-01": (1, 0, 1), "2024-02": (2, 1, 1)}


def test_bands_and_choice_do_not_see_test_labels(spark, learned):
    pdf, rows, features, model = learned
    raised = rows.withColumn("muc_thuong_luu", F.when(F.col("split") == "test", F.col("muc_thuong_luu") + 1000).otherwise(F.col("muc_thuong_luu")))
    again = fc.DirectForecaster(features, 12).fit(raised)
    as_rows = lambda m: sorted((r.step, round(r["_lo"], 6), round(r["_hi"], 6)) for r in m.offsets.collect())
    assert as_rows(again) == as_rows(model)
    for make in (lambda d: fc.backtest_persistence(d, 12, labels_inside=True), lambda d: fc.backtest_seasonal(d, 12, 24, labels_inside=True)):
        a, b = make(rows), make(raised)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0


def test_saved_forecaster_predicts_alike(spark, learned, tmp_path):
    _, rows, features, model = learned
    model.save(str(tmp_path / "m"))
    loaded = fc.DirectForecaster(features, 12).load(spark, str(tmp_path / "m"))
    assert sorted(map(str, loaded.forecast(rows, 12).collect())) == sorted(map(str, model.forecast(rows, 12).collect()))


def test_short_series_get_rows_without_bands(spark, learned):
    _, rows, features, model = learned
    short = rows.withColumns({c: F.lit(None).cast("double") for c in features}).filter("time_idx < 20").withColumns(
        {"site_id": F.lit("short"), "series_len": F.lit(20).cast("bigint")})
    out = model.forecast(short).collect()
    assert len(out) == 12 and all(r.q50 is None and r.q10 is None for r in out)
