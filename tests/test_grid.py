"""Grid and gap filling against pandas, with chunk borders inside the gaps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException

from brimline.operators.grid import regularize


def expected(pdf, freq="1h", limit=48):
    out = []
    for sid, g in pdf.groupby("site_id", sort=False):
        g = g.sort_values("timestamp").set_index("timestamp").asfreq(freq)
        gap = g.isna().any(axis=1)
        num = [c for c in g.columns if c not in ("site_id", "note")]
        g[num] = g[num].astype(float).interpolate(method="time", limit=limit, limit_direction="both")
        g[num] = g[num].ffill().bfill()
        g["was_imputed"] = gap.astype(int)
        g["site_id"] = sid
        out.append(g.reset_index())
    return pd.concat(out).sort_values(["site_id", "timestamp"]).reset_index(drop=True)


def panel(seed=3):
    rng = np.random.default_rng(seed)
    rows = []

    def series(site, start, hours, drop, y=None, z_null=()):
        t = pd.Timestamp(start) + pd.to_timedelta(np.arange(hours), unit="h")
        y = rng.normal(100, 5, hours) if y is None else y
        z = rng.normal(0, 1, hours)
        for i in range(hours):
            if i not in drop:
                rows.append((site, t[i], y[i], np.nan if i in z_null else z[i], "x"))

    for n, gap in enumerate([47, 48, 49, 96, 97, 100, 90]):
        series(f"gap{gap}", f"2024-02-2{n} 03:20", 400, set(range(150, 150 + gap)))
    series("random", "2024-01-01", 700, set(np.flatnonzero(rng.random(700) < 0.4)) - {0})
    series("edges", "2023-12-30 05:00", 300, set(), z_null=set(range(60)) | set(range(230, 300)))
    series("allnull", "2024-01-01", 30, {7}, z_null=set(range(30)))
    series("constant", "2024-01-01", 50, {3, 4}, y=np.full(50, 2.5))
    series("single", "2024-01-01 10:30", 1, set())
    series("old", "1969-12-20 10:30", 600, set(range(20, 500)))
    pdf = pd.DataFrame(rows, columns=["site_id", "timestamp", "y", "z", "note"])
    off = pd.DataFrame(
        [("random", pd.Timestamp("2024-01-03 00:17"), 1e6, 1e6, "x"),
         ("random", pd.Timestamp("2024-01-30 04:17"), 1e6, 1e6, "x")], columns=pdf.columns)
    return pd.concat([pdf, off]).sample(frac=1, random_state=1)


@pytest.mark.parametrize("chunk_steps", [7, 50, 3840])
def test_matches_pandas(spark, chunk_steps):
    pdf = panel()
    want = expected(pdf)
    got = regularize(spark.createDataFrame(pdf), chunk_steps=chunk_steps).toPandas()
    got = got.sort_values(["site_id", "timestamp"]).reset_index(drop=True)
    assert len(got) == len(want)
    assert (got.site_id == want.site_id).all()
    assert (got.timestamp == want.timestamp).all()
    assert (got.was_imputed == want.was_imputed).all()
    for c in "yz":
        assert (got[c].isna() == want[c].isna()).all()
        assert np.nanmax(np.abs(got[c] - want[c])) < 1e-9
    assert (got.note.isna() == want.note.isna()).all()
    assert (got.time_idx == got.groupby("site_id").cumcount()).all()
    assert (got.series_len == got.groupby("site_id").time_idx.transform("size")).all()


def test_unfilled_keeps_gaps(spark):
    pdf = panel()
    got = regularize(spark.createDataFrame(pdf), fill=False, chunk_steps=50).toPandas()
    want = expected(pdf)
    assert len(got) == len(want)
    on_grid = want.was_imputed.eq(0).sum()
    assert got.was_imputed.eq(0).sum() == on_grid


def test_duplicates_raise(spark):
    t = pd.Timestamp("2024-01-01")
    df = spark.createDataFrame(pd.DataFrame({"site_id": ["a"] * 2, "timestamp": [t] * 2, "y": [1.0, 2.0]}))
    with pytest.raises(PySparkException, match="deduplicate"):
        regularize(df).collect()


def test_corrupt_time_is_refused(spark):
    t = [pd.Timestamp("2024-01-01"), pd.Timestamp("2199-01-01")]
    df = spark.createDataFrame(pd.DataFrame({"site_id": ["a"] * 2, "timestamp": t, "y": [1.0, 2.0]}))
    with pytest.raises(PySparkException, match="grid steps"):
        regularize(df, max_steps=10_000).collect()
