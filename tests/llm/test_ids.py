import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brimline.llm import id_store, packing
from brimline.llm.tokens import VOCABULARY, Encoder, vocabulary_path


@pytest.fixture(scope="module")
def whole():
    """Ids of a whole text by the library alone."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_cut_encoding_equals_whole(whole, documents, edge_rows):
    texts = [r.text for r in documents.collect()] + [r[1] or "" for r in edge_rows]
    blanks = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　"
    r = random.Random(1)
    texts += ["".join(r.choice(blanks + "ab1.,'é🙂́") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    small = Encoder(vocabulary_path(), remembered=500)
    assert [np.frombuffer(b, "<u4").tolist() for b in small.encode(texts)] == [whole(t) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for t in texts for b in small.encode([t])] == [whole(t) for t in texts]


def store_rows(rows, whole):
    out, before = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*whole(text), 2]
        out.append((doc_id, before, len(ids), crc(ids)))
        before += len(ids)
    return out


def test_store_round_trip(spark, documents, whole, tmp_path):
    id_store.write_ids(documents, f"{tmp_path}/s", VOCABULARY, 2, shard_bytes=20_000)
    got = sorted(map(tuple, id_store.read_ids(spark, f"{tmp_path}/s").collect()))
    assert got == store_rows([(r.doc_id, r.text) for r in documents.collect()], whole)
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = {r.doc_id: r.ids for r in id_store.lookup(spark, f"{tmp_path}/s", [0, 7, 199, 5000, -3]).collect()}
    assert found == {k: [*whole(texts[k]), 2] for k in (0, 7, 199)}


def test_store_edges(spark, edge_docs, edge_rows, no_docs, whole, tmp_path):
    id_store.write_ids(edge_docs, f"{tmp_path}/e", VOCABULARY, 2, shard_bytes=1000)
    got = id_store.read_ids(spark, f"{tmp_path}/e", with_ids=True).collect()
    want = store_rows([(r[0], r[1]) for r in edge_rows], whole)
    key = lambda r: (str(r[0]), r[2], r[3])
    assert sorted(((r.doc_id, 0, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((a, 0, n, c) for a, _, n, c in want), key=key)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert id_store.lookup(spark, f"{tmp_path}/e", [4]).count() == 3
    id_store.write_ids(no_docs, f"{tmp_path}/n", VOCABULARY, 2)
    assert id_store.read_ids(spark, f"{tmp_path}/n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_index_is_minimal_and_perfect(n):
    keys = np.array(random.Random(n).sample(range(-10**12, 10**12), n), dtype=np.int64)
    index = id_store.build_index(keys)
    assert sorted(index[2].tolist()) == list(range(n))
    assert [id_store.find(int(k), n, *index) for k in keys] == list(range(n))
    assert sum(id_store.find(k, n, *index) is not None for k in range(10**13, 10**13 + 2000)) <= 2


def check_packing(got, rows, whole, capacity):
    want = Counter()
    for doc_id, text in rows:
        ids = [*whole(text), 0]
        first = len(ids) % capacity or capacity
        for k, s in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[s:s + (first if k == 0 else capacity)]
            want[doc_id, k, s, len(part), crc(part)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, documents, edge_docs, edge_rows, no_docs, whole):
    got = packing.pack(documents, VOCABULARY).collect()
    n = check_packing(got, [(r.doc_id, r.text) for r in documents.collect()], whole, 2048)
    assert n <= 1 + -(-sum(r.length for r in got) // 2048)
    got = packing.pack(edge_docs, VOCABULARY, capacity=100).collect()
    check_packing(got, [(r[0], r[1]) for r in edge_rows], whole, 100)
    assert packing.pack(no_docs, VOCABULARY).count() == 0


def best(counts, capacity):
    """The fewest sequences, by trying everything."""
    items = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)
    found = len(items)

    def place(i, rooms):
        nonlocal found
        if len(rooms) >= found:
            return
        if i == len(items):
            found = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return found


def test_reduction_keeps_an_optimum():
    """What is fixed plus an optimum of the rest is an optimum of the whole."""
    r = random.Random(7)
    for _ in range(300):
        capacity = r.randint(6, 20)
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(1, 9)))
        plan = packing.Plan(counts, capacity)
        plan.reduce()
        left = {x: int(n) for x, n in enumerate(plan.left) if n}
        assert plan.fixed + best(left, capacity) == best(counts, capacity), (capacity, counts)


def test_plan_places_every_piece_once():
    r = random.Random(9)
    for _ in range(100):
        capacity = r.randint(5, 60)
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(1, 400)))
        plan = packing.Plan(counts, capacity).solve()
        bins = defaultdict(list)
        for x, (first, start, place, per) in plan.tables().items():
            for rank in range(counts[x]):
                k = np.searchsorted(first, rank, side="right") - 1
                nth = rank - first[k]
                bins[start[k] + nth // per[k]].append((place[k] + nth % per[k] * x, x))
        assert len(bins) == plan.sequences
        for b in bins.values():
            at = 0
            for offset, x in sorted(b):
                assert offset == at
                at += x
            assert at <= capacity


def test_wrong_index_fails_the_read():
    keys = [None, None, 3, 3, 5, 8, 13, 21, 34]
    row = id_store.shard_row(0, 0, 2, 0, keys, [np.array([i, 2], dtype="<u4").tobytes() for i in range(len(keys))]).to_pylist()[0]
    assert id_store.positions_of(row).tolist() == list(range(len(keys)))
    failed = 0
    for i in range(len(row["displacements"])):
        wrong = {**row, "displacements": [d + (k == i) * (17 if d >= 0 else -1 if -d < len(row["places"]) else 1) for k, d in enumerate(row["displacements"])]}
        try:
            assert id_store.positions_of(wrong).tolist() != []
        except ValueError:
            failed += 1
    assert failed == len(row["displacements"])
    swapped = {**row, "places": [*reversed(row["places"])]}
    with pytest.raises((ValueError, AssertionError)):
        assert id_store.positions_of(swapped).tolist() == list(range(len(keys)))


def test_pieces_are_encoded_once(whole):
    """A word with different marks and line ends after it is one new piece: before, each such part was new."""
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(9)) for _ in range(300)]
    texts = [" ".join(r.choice(words) + r.choice(["", ",", ".\n" + r.choice(words), "'s", "!)"]) for _ in range(4000)) for _ in range(3)]
    small = Encoder(vocabulary_path())
    asked = []
    alone = small.whole
    small.whole = lambda texts: asked.append(sum(t.count(" ") for t in texts) + len(texts)) or alone(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in small.encode(texts)] == [whole(t) for t in texts]
    assert sum(asked) < 3 * len(words)


@pytest.mark.parametrize("remembered", [3, 500, 250_000])
def test_cuts_of_odd_texts(whole, remembered):
    """Contractions, runs of blanks, marks beyond ASCII, zero characters, added tokens, long pieces."""
    r = random.Random(3)
    alphabets = ["ab' '' stvreml'd 1.,\n", "  \n\n\tab'sé×÷ɏɐ“”’–x9", "日本ab ' \n.<|>\x00\x7f ​²½٣", " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0᠎  　ab"]
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 30))) for a in alphabets for _ in range(500)]
    texts += ["x <|endoftext|> y", "a<|endoftext|>", "", "'s", "'", " '", "'ll're", "\n\n", "a\n\n b", "it's they'll 'tis ''s 'S", "b" * 5000 + " " + "c" * 300]
    r.shuffle(texts)
    small = Encoder(vocabulary_path(), remembered)
    for a in range(0, len(texts), 400):
        assert [np.frombuffer(b, "<u4").tolist() for b in small.encode(texts[a:a + 400])] == [whole(t) for t in texts[a:a + 400]]
    assert len(small.known) <= remembered and all(len(p) <= 100 for p in small.known.to_pylist())
