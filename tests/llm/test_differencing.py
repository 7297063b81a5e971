import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from brimline.llm import differencing
from brimline.llm.common import prepared
from brimline.llm.differencing import CAPACITY, Packer, differenced, pack
from brimline.llm.tokens import VOCABULARY, vocabulary_path


def checked(rows, want, capacity=CAPACITY):
    """Each id in one piece, sequences without gaps, padding only up to a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for s in by_sequence.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist()
        n = sum(r["length"] for r in s)
        assert 0 < n <= capacity and n & (n - 1) == 0
    count = defaultdict(list)
    for doc_id, ids in want:
        count[(doc_id, len(ids))].append(ids)
    assert by_doc.keys() == count.keys()
    for key, texts in count.items():
        found = by_doc[key]
        assert sum(r["length"] for r in found) == key[1] * len(texts)
        for r in found:
            cut = {zlib.crc32(t[r["start"]:r["start"] + r["length"]].astype("<u4").tobytes()) for t in texts}
            assert r["ids_crc32"] in cut
        if len(texts) == 1:
            found.sort(key=lambda r: r["start"])
            assert [r["start"] for r in found] == np.cumsum([0, *(r["length"] for r in found)])[:-1].tolist()
    return by_sequence


def encoded(rows):
    tokenizer = Tokenizer.from_file(vocabulary_path(VOCABULARY))
    return [(r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0])) for r in rows]


def test_rows_of_all_kinds(spark, edge_docs, edge_rows, no_docs):
    prepared(spark)
    got = [r.asDict() for r in pack(edge_docs, VOCABULARY).collect()]
    checked(got, encoded(edge_rows))
    assert pack(no_docs, VOCABULARY).collect() == []


def test_given_documents(spark, documents):
    prepared(spark)
    got = [r.asDict() for r in pack(documents.repartition(3), VOCABULARY).collect()]
    want = encoded([(r.doc_id, r.text) for r in documents.collect()])
    by_sequence = checked(got, want)
    total = sum(len(ids) for _, ids in want)
    assert len(by_sequence) <= total / CAPACITY + 3 * CAPACITY.bit_length()
    least = sum(-(-len(ids) // CAPACITY) for _, ids in want)
    assert len(got) <= least + 2 * len(by_sequence)


@pytest.mark.parametrize("seed", range(5))
def test_differencing_deals_every_piece_once_and_evenly(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 200) for _ in range(r.choice([7, 60, 900]))]
    for k in (1, 2, 3, len(sizes) // 4 + 1):
        windows = differenced(sizes, k)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert len(windows) <= k
        if len(sizes) >= 6 * k:
            sums = [sum(sizes[i] for i in w) for w in windows]
            assert max(sums) - min(sums) <= max(sizes)


def test_differencing_of_a_known_instance():
    # two ways: 8 7 6 5 4 differ by two after differencing (the optimum is zero)
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differenced([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]
    assert differenced([], 3) == []


@pytest.mark.parametrize("group", [2, 5, 64])
def test_packer_closes_full_windows_only(group):
    r = np.random.default_rng(group)
    packer = Packer(0, 64, group)
    want = []
    for i in range(400):
        ids = r.integers(0, 50_000, int(r.choice([1, 7, 63, 64, 65, 200, r.integers(1, 130)])))
        want.append((i, ids))
        packer.add(i, ids.astype("<u4").tobytes())
        assert len(packer.waiting) < group or packer.held < 64
    packer.finish()
    rows = [dict(zip(differencing.NAMES, x)) for x in packer.out]
    by_sequence = checked(rows, want, 64)
    part = [s for s in by_sequence.values() if sum(x["length"] for x in s) < 64]
    assert len(part) <= 6
