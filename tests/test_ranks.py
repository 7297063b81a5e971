"""Exact ranks from summaries, and what reads whole chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brimline.functions import ranks
from brimline.functions.ranks import Question, narrowed, rank_of, summarized
from brimline.operators import forecast as fc
from brimline.operators.grid import regularize
from brimline.operators.split import split_by_ratio
from brimline.operators.windows import horizon_chunks, window_arrays, window_rows


@pytest.mark.parametrize("values", [
    lambda r: r.normal(size=5000), lambda r: r.integers(0, 3, 5000), lambda r: np.zeros(900),
    lambda r: np.where(r.random(4000) < 0.98, 1.5, r.normal(size=4000)), lambda r: r.normal(size=3), lambda r: 10.0 ** r.integers(-300, 300, 2000),
])
def test_ranks_of_parts(monkeypatch, values):
    monkeypatch.setattr(ranks, "SAMPLES", 16)
    r = np.random.default_rng(1)
    all_of = np.asarray(values(r), dtype=float)
    parts = [np.sort(p) for p in np.split(all_of, np.sort(r.integers(0, len(all_of), 6)))]
    ordered = np.sort(all_of)
    for rank in {1, len(ordered), *(rank_of(q, len(ordered)) for q in (0.01, 0.1, 0.5, 0.9, 0.99))}:
        asked, passes = Question(rank, -np.inf, np.inf, []), 0
        while isinstance(asked, Question):
            asked = narrowed(asked, [summarized(p, asked) for p in parts])
            passes += 1
            assert passes < 30
        assert asked == ordered[rank - 1]


def series(spark, lengths, seed=0):
    r = np.random.default_rng(seed)
    parts = []
    for i, n in enumerate(lengths):
        y = np.where(r.random(n) < 0.3, 2.0, np.round(r.normal(size=n), 2))
        parts.append(pd.DataFrame({"site_id": f"s{i}", "timestamp": pd.date_range("2025-01-01", periods=n, freq="h"), "muc_thuong_luu": y}))
    pdf = pd.concat(parts)
    return pdf, regularize(spark.createDataFrame(pdf))


@pytest.mark.parametrize("chunk_steps,summed", [(4000, 1 << 20), (16, 1 << 20), (16, 40)])
def test_spread_equals_sorted_changes(spark, monkeypatch, chunk_steps, summed):
    monkeypatch.setattr(ranks, "SAMPLES", 8)
    monkeypatch.setattr(fc, "SUMMED_ROWS", summed)
    pdf, df = series(spark, [700, 90, 14, 1])
    got = {(r.site_id, r.step): (r._lo, r._mid, r._hi) for r in fc.persistence_spread(df, 12, chunk_steps=chunk_steps).collect()}
    want = {}
    for s, g in pdf.groupby("site_id"):
        y = g.muc_thuong_luu.to_numpy()
        for h in range(1, 13):
            d = np.sort(y[h:] - y[:-h])
            if len(d):
                want[s, h] = tuple(d[rank_of(q, len(d)) - 1] for q in (0.1, 0.5, 0.9))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_spread_of_a_long_horizon_writes_no_pair(spark):
    _, df = series(spark, [1500])
    df = spark.createDataFrame(df.toPandas())
    plan = horizon_chunks(df, 336, keep=["series_len"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") == 1  # a row goes to its chunk and a halo
    spread = fc.persistence_spread(df, 336, chunk_steps=400)
    assert spread.count() == 336


def test_windows_cross_one_exchange(spark):
    _, df = series(spark, [80])
    df = spark.createDataFrame(df.toPandas())
    plan = window_arrays(df, ["muc_thuong_luu"], 24, 12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(site_id" in plan and "Window" not in plan


@pytest.mark.parametrize("chunk_steps", [10, 4000])
@pytest.mark.parametrize("only,stride", [("all", 1), ("all", 5), ("train", 3), ("validation", 1), ("last", 1)])
def test_window_arrays_equal_rows(spark, chunk_steps, only, stride):
    _, df = series(spark, [60, 19, 8], 3)
    df = df.filter("NOT (site_id = 's0' AND time_idx = 30)")  # a position that is missing
    enc, dec = 6, 3
    rows = window_rows(df, enc, dec, stride, only=only).toPandas()
    want = {}
    for (s, o), g in rows.groupby(["site_id", "origin_idx"]):
        if len(g) == enc + dec:
            g = g.sort_values("step")
            want[s, o] = list(zip(g.step, g.muc_thuong_luu))
    got = {}
    for r in window_arrays(df, ["muc_thuong_luu", "timestamp"], enc, dec, stride, only=only, chunk_steps=chunk_steps).collect():
        got[r.site_id, r.origin_idx] = [(x.step, x.muc_thuong_luu) for x in [*r.encoder, *r.decoder]]
    assert got == want and len(want) > 0


def test_backtest_in_small_chunks(spark):
    _, df = series(spark, [300, 40, 9], 5)
    df = split_by_ratio(df)
    rows = [sorted(map(tuple, fc.backtest_persistence(df, 20, chunk_steps=c).collect())) for c in (32, 4000)]
    assert rows[0] == rows[1] and len(rows[0]) > 100
    inside = fc.backtest_persistence(df, 20, labels_inside=True).count()
    assert 0 < inside < len(rows[0])
