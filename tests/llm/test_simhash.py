import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brimline.llm import simhash as sh


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """doc id, fingerprint, smallest id reachable; rows are (id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    arr = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 3) + i + 1:
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    at = {f: top(i) for i, f in enumerate(fps)}
    low = {}
    for i, f in rows:
        if i is not None:
            low[at[f]] = min(i, low.get(at[f], i))
    return Counter((i, f"{f:016x}", low.get(at[f])) for i, f in rows)


def found(docs, **kw):
    out = sh.near_copies(docs, **kw).select("doc_id", sh.hexadecimal("fp"), "component_id")
    return Counter(map(tuple, out.collect()))


def test_documents_equal_brute_force(documents):
    assert found(documents) == plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in documents.collect()])


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = found(edge_docs)
    assert got == plain_components([(r[0], plain_fingerprint(r[1])) for r in edge_rows])
    assert sh.near_copies(no_docs).count() == 0
    kept = sh.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({c for c in plain_components([(r[0], plain_fingerprint(r[1])) for r in edge_rows]) if c[0] == c[2]})
    assert sh.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("limit", [2048, 30, 4])
def test_links_of_crowded_fingerprints(spark, limit):
    """Clouds of fingerprints around centres, sharing halves; entries split at three sizes."""
    r = random.Random(limit)
    fps = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(150):
            fps.add(centre ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 2, 3, 4, 6]))))
    half = r.getrandbits(32)
    fps |= {half << 32 | r.getrandbits(32) for _ in range(200)}
    fps |= {half << 32 | sum(1 << b for b in r.sample(range(32), 4)) for _ in range(300)}
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    edges = sh.all_links(df, entry_limit=limit)
    roots = {x.node: x.root for x in sh.components(edges).collect()}
    label = {f: roots.get(f, f) for f in signed}
    want = plain_components(list(enumerate(fps)))
    ids = {i: c for i, _, c in want}
    groups = {}
    for i, f in enumerate(signed):
        groups.setdefault(label[f], set()).add(ids[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(ids.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    star = [(1, i) for i in range(1000, 1400)]
    df = spark.createDataFrame(chain + star, "a bigint, b bigint").orderBy(F.xxhash64("a", "b"))
    got = {r.node: r.root for r in sh.components(df).collect()}
    assert got == {**{i: 100 for i in range(101, 401)}, **{i: 1 for i in range(1000, 1400)}}
