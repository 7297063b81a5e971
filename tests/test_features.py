import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.operators.features import add_calendar, add_lags_rollings, add_position, fill_features
from brimline.operators.grid import regularize
from brimline.plans.prepare import prepare
from tests.test_grid import expected, panel

LAGS, WINDOWS = [1, 3, 6, 24, 48], [1, 2, 3, 12, 13, 17, 24, 34, 48]


def pandas_features(g, lags, windows):
    out = []
    for _, s in g.groupby("site_id", sort=False):
        s = s.sort_values("timestamp").copy()
        for n in lags:
            s[f"y_lag_{n}"] = s.y.shift(n)
        for size in windows:
            r = s.y.shift(1).rolling(size, min_periods=max(1, size // 3))
            s[f"y_rolling_mean_{size}"], s[f"y_rolling_std_{size}"] = r.mean(), r.std()
        out.append(s)
    return pd.concat(out).sort_values(["site_id", "timestamp"]).reset_index(drop=True)


def compare(got, want, cols, tol=1e-7):
    got = got.sort_values(["site_id", "timestamp"]).reset_index(drop=True)
    assert (got.timestamp == want.timestamp).all() and (got.site_id == want.site_id).all()
    for c in cols:
        a, b = got[c].astype(float), want[c].astype(float)
        assert (a.isna() == b.isna()).all(), c
        assert not len(a.dropna()) or np.nanmax(np.abs(a - b)) < tol, c


@pytest.mark.parametrize("chunk_steps", [60, 3840])
def test_prepare_matches_pandas(spark, chunk_steps):
    pdf = panel().drop(columns=["note", "z"])
    want = pandas_features(expected(pdf), LAGS, WINDOWS)
    got = prepare(spark.createDataFrame(pdf), target="y", lags=LAGS, windows=WINDOWS, chunk_steps=chunk_steps)
    cols = [c for c in want.columns if c.startswith("y")]
    compare(got.toPandas(), want, cols)


def test_irregular_rows_with_nulls(spark):
    rng = np.random.default_rng(0)
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 9000, 500)), unit="min")
    pdf = pd.DataFrame({"site_id": "a", "timestamp": t, "y": rng.normal(size=500)})
    pdf.loc[rng.random(500) < 0.5, "y"] = np.nan
    pdf = pd.concat([pdf, pdf.head(40).assign(site_id="b", y=7.25)])
    want = pandas_features(pdf, LAGS, WINDOWS)
    df = spark.createDataFrame(pdf).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    got = add_lags_rollings(df, "y", LAGS, WINDOWS, chunk_steps=64).toPandas()
    compare(got, want, [c for c in want.columns if c.startswith("y_")])


def test_position_and_fill(spark):
    rng = np.random.default_rng(1)
    t = pd.Timestamp("2020-01-01") + pd.to_timedelta(np.arange(900) * 7, unit="h")
    pdf = pd.concat([pd.DataFrame({"site_id": s, "timestamp": t[: 300 * (i + 1)],
                                   "a": rng.normal(size=300 * (i + 1)), "b": np.nan})
                     for i, s in enumerate("xyz")])
    pdf.loc[rng.random(len(pdf)) < 0.6, "a"] = np.nan
    pdf.loc[pdf.timestamp < "2020-02-10", "a"] = np.nan
    pdf = pdf.reset_index(drop=True)
    df = spark.createDataFrame(pdf)
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "ab"})
    got = add_position(df).toPandas().sort_values(["site_id", "timestamp"])
    assert (got.time_idx == got.groupby("site_id").cumcount()).all()
    assert (got.series_len == got.groupby("site_id").time_idx.transform("size")).all()
    for backward in (True, False):
        out = fill_features(df, ["a", "b"], backward=backward, chunk_steps=50)
        assert out.columns == df.columns
        out = out.toPandas().sort_values(["site_id", "timestamp"]).reset_index(drop=True)
        want = pdf.groupby("site_id").a.ffill()
        if backward:
            want = want.groupby(pdf.site_id).bfill()
        assert (out.a.isna() == want.isna()).all()
        assert np.allclose(out.a.fillna(0), want.fillna(0))
        assert out.b.isna().all()


def test_calendar_in_local_time(spark):
    t = pd.date_range("2024-02-27", "2024-03-05", freq="h", tz="UTC")
    df = spark.createDataFrame(pd.DataFrame({"timestamp": t.tz_localize(None)}))
    for tz in ("Asia/Bangkok", "Europe/Berlin"):
        got = add_calendar(df, tz=tz).toPandas().sort_values("timestamp").reset_index(drop=True)
        wall = t.tz_convert(tz)
        assert (got.hour == wall.hour).all() and (got.dow == wall.dayofweek).all()
        assert (got.doy == wall.dayofyear).all()
        assert (got.is_weekend == (wall.dayofweek >= 5)).all()
        assert np.allclose(got.doy_cos, np.cos(2 * np.pi * wall.dayofyear / 366))


def test_border_of_two_series(spark):
    t = pd.date_range("2024-01-01", periods=5, freq="h")
    pdf = pd.concat([pd.DataFrame({"site_id": s, "timestamp": t, "y": [base] * 5})
                     for s, base in (("a", 1.0), ("b", 100.0))])
    got = add_lags_rollings(regularize(spark.createDataFrame(pdf)), "y", [1], [3]).toPandas()
    first_b = got[(got.site_id == "b") & (got.time_idx == 1)].iloc[0]
    assert first_b.y_rolling_mean_3 == 100.0 and first_b.y_lag_1 == 100.0
