import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brimline.llm import topk

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("norm", T.StringType()),
])


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(1024 * float(np.float32(x))) for x in v]


def brute(rows, k, every):
    out = []
    vs = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    for q, a in vs:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vs if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def search(df, k, every):
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, k).collect()))


def test_given_vectors_by_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert search(df, 10, 10) == brute([(r.vec_id, r.embedding) for r in df.collect()], 10, 10)


@pytest.mark.parametrize("seed", range(4))
def test_mixed_lengths_ties_and_bad_vectors(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "SEED_VECTORS", [1024, 3, 20, 0][seed])
    r = random.Random(seed)
    rows = []
    for i in range(300):
        size = 10 ** r.uniform(-2, 2)
        centre = [r.gauss(0, 1) for _ in range(4)] if i % 3 else [1.0, 0.5, 0.0, -0.5]
        rows.append((i, [size * c for c in centre]))
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300, 400)]  # a vector many rows share
    rows += [(400, None), (410, []), (420, [1.0, None]), (430, [float("nan"), 1.0]), (440, [float("inf")]), (450, [0.0] * 4),
             (460, [1.0]), (470, [2.0, 1.0, 0.0, 0.0, 9.0]), (None, [9.0, 9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS).repartition(4)
    assert search(df, 10, 10) == brute(rows, 10, 10)


def test_few_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert search(none, 10, 1) == []
    one = spark.createDataFrame([(0, [1.0], "", "", ""), (1, [2.0], "", "", "")], VECTORS)
    assert search(one, 10, 1) == [(0, 1, 1, 1024 * 2048), (1, 1, 0, 1024 * 2048)]


def test_pruning_loses_nothing_above_the_threshold():
    r = np.random.default_rng(1)
    m = (r.normal(size=(400, 8)) * 300).astype(np.int64)
    order = np.argsort(-topk.norms(m))
    block = topk.Block(np.arange(400)[order], m[order])
    q = (r.normal(size=(50, 8)) * 300).astype(np.int64)
    scores = q @ m.T
    used = 0
    for share in (0.3, 0.7, 0.95):
        floor = np.quantile(scores, 0.9, axis=1).astype(np.int64) if share < 0.5 else (share * topk.norms(q) * block.longest).astype(np.int64)
        got = {i: set(ids[s >= floor[i]].tolist()) for i, ids, s in topk.search((np.arange(50), q), floor, block, 10)}
        used += sum(len(ids) < 400 for _, ids, _ in topk.search((np.arange(50), q), floor, block, 10))
        for i in range(50):
            assert got.get(i, set()) == set(np.flatnonzero(scores[i] >= floor[i]).tolist())
    assert used > 50


def test_large_components_are_exact(spark):
    r = random.Random(8)
    rows = [(i, [float(np.float32(r.uniform(-1, 1) * 10 ** r.choice([0, 5, 6]))) for _ in range(6)]) for i in range(120)]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)
    got = search(df, 10, 10)
    assert got == brute(rows, 10, 10) and max(x[3] for x in got) > 1 << 53
    # 1e9 beside zeros: the products still fit, a clamp would not show them
    rows = [(0, [1e9, 0.0]), (1, [0.0, 1e9]), (2, [1.0, 2.0]), (3, [3.0, -1.0]), (4, [1e9, 1e9])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)
    want = [(q, n, i, max(-(2**63) + 1, min(2**63 - 1, s))) for q, n, i, s in brute(rows, 10, 1)]
    assert search(df, 10, 1) == want


def test_only_blocks_that_reach_a_score_get_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 20)
    monkeypatch.setattr(topk, "SEED_VECTORS", 100)
    seen = []
    inner = topk.search
    monkeypatch.setattr(topk, "search", lambda *a: seen.append(1) or inner(*a))
    r = random.Random(1)
    # lengths fall quickly and all directions agree, so few blocks can hold a best one
    rows = [(i, [2.0 ** -(i / 40) * (1 + 0.01 * r.random())] * 4) for i in range(1000)]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)
    assert search(df, 5, 50) == brute(rows, 5, 50)
    assert topk.least_length(np.array([10, 20]), np.array([1.0, 4.0])) == 5.0
    assert topk.least_length(np.array([10, 0]), np.array([1.0, 4.0])) < 0


def spread_rows(n=400, seed=3):
    r = random.Random(seed)
    return [(i, [r.uniform(0.1, 10) * r.gauss(0, 1) for _ in range(4)]) for i in range(n)]


def test_no_side_of_the_join_is_broadcast_by_a_guess(spark):
    """Before, queries copied once per lane were taken for as small as one copy and sent to the driver."""
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in spread_rows()], VECTORS)
    plan = topk.top_k(df, F.col("vec_id") % 10 == 0, 10)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_seeds_come_as_a_few_whole_blocks(spark, monkeypatch):
    """Before, every task sent its longest vectors to the driver."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "SEED_VECTORS", 50)
    rows = spread_rows()
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS).repartition(7)
    dealt = topk.vectors(df).repartitionByRange(5, F.col("norm").desc()).sortWithinPartitions(F.col("norm").desc(), "id")
    blocks = topk.settled(topk.blocked(dealt, topk.BLOCK), "blocks")
    size = {i: sum(x * x for x in whole(v)) for i, v in rows}
    ids, m = topk.longest_vectors(blocks)
    assert ids.tolist() == sorted(size, key=lambda i: -size[i])[:50]
    assert [size[i] for i in ids.tolist()] == [int(x) for x in (m ** 2).sum(axis=1)]
    monkeypatch.setattr(topk, "SEED_BYTES", 1)  # one block at least
    assert topk.longest_vectors(blocks)[0].tolist() == ids[:16].tolist()
    monkeypatch.setattr(topk, "SEED_VECTORS", 0)
    assert topk.longest_vectors(blocks)[0].tolist() == []


def test_groups_of_queries_meet_all_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("QUERY_BLOCK", 5), ("SEED_VECTORS", 20), ("PAIRS", 4), ("GROUP_BYTES", 2000)):
        monkeypatch.setattr(topk, name, value)
    made, inner = [], topk.tiles
    monkeypatch.setattr(topk, "tiles", lambda *a: made.append(inner(*a)) or made[-1])
    rows = spread_rows()
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)
    assert search(df, 10, 2) == brute(rows, 10, 2)
    assert made[0][0] > 1 and made[0][1] > 1
