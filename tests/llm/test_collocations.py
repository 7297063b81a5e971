import random
import re
from collections import Counter

import numpy as np
import pytest

from brimline.llm import collocations as C
from brimline.llm.common import prepared


def brute(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in often.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                if 100 * a >= 80 * f[lang, p[i:i + size]]:
                    gone.add((lang, p[i:i + size]))
    best = {}
    for (lang, p), a in often.items():
        if (lang, p) not in gone:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            phrase = " ".join(p)
            best.setdefault(lang, []).append((-score, -a, phrase.encode(), (phrase, a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)))
    return sorted((lang, i + 1, *x[3]) for lang, some in best.items() for i, x in enumerate(sorted(some)[:top]))


def mined(df, **how):
    return sorted(map(tuple, C.collocations(df, **how).collect()))


def test_given_documents_by_brute_force(spark, documents):
    prepared(spark)
    want = brute([(r.text, r.lang) for r in documents.collect()], 30)
    assert mined(documents.repartition(4)) == want and len(want) > 20


def test_rows_of_all_kinds(spark, edge_docs, edge_rows, no_docs):
    prepared(spark)
    rows = [(r[1], r[2]) for r in edge_rows]
    for least in (2, 3):
        assert mined(edge_docs, least=least) == brute(rows, least)
    assert mined(no_docs) == [] and mined(edge_docs, least=10 ** 9) == []


def test_ties_ends_and_few_ranks(spark):
    prepared(spark)
    r = random.Random(3)
    texts = []
    for i in range(300):
        words = [r.choice(["New", "york", "CITY", "éa", "Éa", "x\x01", "x", "of", "the", "a\x0bb", "c.d"]) for _ in range(r.randint(0, 30))]
        texts.append((r.choice(["  ", " ", "\t", ", "]).join(words), ["en", "fr", None, "und"][i % 4]))
    df = spark.createDataFrame(texts, "text string, lang string").repartition(5)
    for top in (7, 2000):
        assert mined(df, least=4, top=top) == brute(texts, 4, top)


def test_counts_beyond_a_byte_and_scores_beyond_64_bits(spark):
    prepared(spark)
    rows = [("alpha beta gamma delta", "en")] * 700 + [("alpha gamma", "en")] * 300
    df = spark.createDataFrame(rows, "text string, lang string")
    assert mined(df) == brute(rows, 30)
    grams = spark.createDataFrame([([1], 1 << 61), ([2], 1 << 60), ([1, 2], (1 << 60) - 1)], "ids array<bigint>, f bigint")
    assert C.scored(grams).first()["score"] == 2_000_000 * ((1 << 60) - 1) // (3 << 60)


@pytest.mark.parametrize("n,w,s", [(2, 1, 0), (2, 5, 3), (3, 17, 4), (4, 16, 11), (2, 32, 9), (3, 32, 0), (4, 32, 12), (4, 3, 6)])
def test_filters_are_lossless(n, w, s):
    r = np.random.default_rng(n * w)
    grams = r.integers(0, 1 << w, (3000, n)).astype(np.uint32)
    hi, lo, h = C.packed(grams, w)
    hi, lo = C.permuted(hi, lo, h)
    back = C.restored(hi, lo, h)
    assert (C.unpacked(*back, n, w) == grams).all()
    counts = r.choice([1, 2, 254, 255, 256, 1 << 40], len(hi)).astype(np.int64)
    want = Counter()
    for g, c in zip(map(tuple, grams.tolist()), counts.tolist()):
        want[g] += c
    got = Counter()
    # two filters of each shard, merged
    halves = [C.summed(hi[a::2], lo[a::2], counts[a::2], h)[:3] for a in (0, 1)]
    for shard in range(1 << s):
        filters = []
        for a, b, c in halves:
            at = C.top_bits(a, b, h, s) == shard
            if at.any():
                filters.append(C.filter_of(a[at], b[at], c[at], h, s))
        if filters:
            a, b, totals, _, places = C.merged(filters)
            assert sum(map(len, places)) >= len(a)
            again = C.entries_of(C.filter_of(a, b, totals, h, s))
            assert (again[0] == a).all() and (again[1] == b).all() and (again[2] == totals).all()
            for g, c in zip(map(tuple, C.unpacked(*C.restored(a, b, h), n, w).tolist()), totals.tolist()):
                got[g] += c
    assert got == want
