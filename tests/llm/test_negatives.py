import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brimline.llm import negatives
from brimline.llm.negatives import hard_negatives

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in ("v", "cid", "ids", "qid", "leaf", "anchor_id")],
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], VECTORS)


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return tuple(math.floor(256 * x) for x in v)


def brute(rows, every, scale=1):
    rows = {(i, l, whole(v)) for i, v, l in rows if i is not None and l is not None and whole(v) is not None}
    out = []

    def ranked(a, some):
        return sorted((-sum(x * y for x, y in zip(a, v)), i) for i, _, v in some)

    for own in rows:
        q, label, a = own
        if q % every:
            continue
        away = [r for r in rows if r[1] != label]
        for s, p in ranked(a, [r for r in rows if r[1] == label and r != own])[:5]:
            hard = [(n, i) for n, i in ranked(a, away) if 30 * -s <= 100 * -n <= 90 * -s][:10]
            out += [(q, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(hard)]
    return sorted(out)


def mined(df, every):
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % every == 0, F.col("label")).collect()))


def test_given_vectors_by_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    assert mined(df, 10) == brute(rows, 10)


@pytest.mark.parametrize("seed", range(3))
def test_ties_copies_and_bad_rows(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "SAMPLE", [4096, 60, 20][seed])
    monkeypatch.setattr(negatives, "FANOUT", [16, 3, 4][seed])
    monkeypatch.setattr(negatives, "LEAF_SAMPLE", 5)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 7)
    r = random.Random(seed)
    rows = []
    for i in range(260):
        centre = [[3, 0, 1], [0, 2, 2], [-1, 1, 0]][i % 3]
        rows.append((i, [10 ** r.uniform(-1, 1) * (c + r.gauss(0, 0.2)) for c in centre], r.randrange(3)))
    rows += [(i, [1.0, 1.0, 0.5], i % 2) for i in range(260, 400)]  # a vector many rows share
    rows += [(i, [0.5, 0.5, 0.25], 2) for i in range(400, 430)]
    rows += [(430, None, 0), (440, [1.0, None], 0), (450, [float("nan")], 0), (460, [float("inf")], 1), (470, [], 1),
             (480, [0.0] * 3, 2), (490, [2.0], 0), (500, [1.0, 1.0, 0.5, 7.0], None), (None, [1.0], 1)]
    rows += [(0, [2.0, 1.0, 1.0], 1), rows[10], rows[10], rows[20]]  # an id twice, and rows again
    assert mined(frame(spark, rows).repartition(3), 10) == brute(rows, 10)


def test_large_components_stay_exact(spark):
    r = random.Random(4)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.choice([0, 6, 6.3]) for _ in range(5)], i % 2) for i in range(80)]
    got = mined(frame(spark, rows), 5)
    assert got == brute(rows, 5) and max(x[4] for x in got) > 1 << 53


def test_few_rows(spark):
    assert mined(frame(spark, []), 1) == []
    one = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1), (3, [-0.5], 1)]
    assert mined(frame(spark, one), 1) == brute(one, 1) != []


def test_ranges_prune_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 6)) * 4
    rows = [(i, (centres[i % 40] + r.normal(size=6) * 0.05).tolist(), int(i % 3)) for i in range(2000)]
    members = negatives.classes(negatives.taken(frame(spark, rows), F.col("label"), "vec_id", "embedding"), 1)
    index = negatives.built(members)
    assert index.blocks.agg(F.sum("n")).first()[0] == members.count()
    asked = members.filter("ids[0] % 20 = 0").selectExpr("cid AS qid", "label", "v", "-9000000000L AS low", "9000000000L AS high")
    pairs = negatives.left_blocks(index, asked, True, 3).count()
    assert pairs < 0.3 * asked.count() * index.blocks.count()
    got = {}
    for x in negatives.searched(index, asked, True, 3).collect():
        got.setdefault(x.qid, []).append(x.score)
    data = [(x.cid, x.label, np.array(x.v)) for x in members.collect()]
    for q, label, v in data:
        if q in got:
            want = sorted((int(v @ w) for _, other, w in data if other == label), reverse=True)[:3]
            assert sorted(got[q], reverse=True) == want
    assert len(got) == asked.count()
