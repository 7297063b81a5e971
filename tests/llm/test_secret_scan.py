import hashlib
import math
import re
from collections import Counter

from brimline.llm import secret_scan as ss

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def markov_spans(text, models):
    out = []
    for m in re.finditer(ss.TOKEN, text or ""):
        codes = [ss.SYMBOLS.index(c) for c in m[0]]
        n = len(codes) - 1
        threshold = max(ss.MIN_RATIO, n * models.drift + math.sqrt(n) * (ss.DEVIATIONS * models.spread))
        ratio = sum(models.ratio[a * models.width + b] for a, b in zip(codes, codes[1:]))
        if len(re.findall("[A-Za-z]", m[0])) > 1 and ratio >= threshold:
            out.append((m.start(), 3, m.end()))
    return out


def listed(spans):
    return ",".join(f"{ss.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def expected(rows, models):
    out = []
    for doc_id, text in rows:
        base = base_spans(text)
        n = Counter(k for _, k, _ in base)
        extra = markov_spans(text, models) if models else []
        out.append((doc_id, n[0], n[1], n[2], len(extra), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + extra)))
    return sorted(out, key=str)


def test_spans_equal_brute_force_on_documents(spark, documents):
    models = ss.train(ss.labelled_tokens(documents))
    got = sorted(map(tuple, ss.scan(documents, models).collect()), key=str)
    want = expected([(r.doc_id, r.text) for r in documents.collect()], models)
    assert got == want
    assert sum(r[1] + r[2] + r[3] for r in got) > 5


def test_edge_texts(edge_docs, edge_rows, no_docs, documents):
    models = ss.train(ss.labelled_tokens(documents))
    got = sorted(map(tuple, ss.scan(edge_docs, models).collect()), key=str)
    assert got == expected([(r[0], r[1]) for r in edge_rows], models)
    assert ss.scan(no_docs, models).count() == 0
    assert ss.train(ss.labelled_tokens(no_docs)) is None
    assert ss.scan(edge_docs, None).count() == len(edge_rows)


def test_models_tell_random_strings_from_identifiers(spark):
    """Held out: strings and identifiers the models have not seen, at every length from 12."""
    import random

    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(3)
    models = ss.train(ss.labelled_tokens(documents))
    assert models.drift < 0 < models.spread
    words = [w for row in documents.collect() for w in re.findall(r"[A-Za-z]{3,}", row.text)]

    def identifier(n):
        out = r.choice(words)
        while len(out) < n:
            out += r.choice(("_", "-", "")) + r.choice(words)
        return out[:n]

    share = lambda tokens: sum(bool(markov_spans(t, models)) for t in tokens) / len(tokens)
    for n, least in ((12, 0.7), (16, 0.85), (20, 0.9), (32, 0.97)):
        assert share([identifier(n) for _ in range(400)]) <= 0.01
        assert share(["".join(r.choice(ss.SYMBOLS[:62]) for _ in range(n)) for _ in range(400)]) >= least
        assert share([f"{r.randrange(16 ** n):0{n}x}" for _ in range(400)]) >= 0.95


def test_numbers_dates_and_times_are_not_scored(spark, documents):
    models = ss.train(ss.labelled_tokens(documents))
    text = "2024-01-01T10 4111-1111-1111-1111 +1-269-555-3296 2026-12-31T23-59-59 00000000-1111"
    assert markov_spans(text, models) == []
    row = ss.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), models).first()
    assert (row.n_markov, row.spans) == (0, "")


def test_thresholds_follow_held_out_tokens(spark):
    """Drift and spread by hand: three tokens under a table that gives each transition its own ratio."""
    width = len(ss.SYMBOLS)
    table = [0.0] * (width * width)
    table[1], table[width] = -1.0, -3.0  # ab, ba
    held = spark.createDataFrame([("ab", 0), ("aba", 0), ("abab", 0)], "token string, random int")
    models = ss.with_thresholds(ss.Models(tuple(table), width), held)
    sums, steps = [-1.0, -4.0, -5.0], [1, 2, 3]
    drift = sum(sums) / sum(steps)
    spread = math.sqrt(sum((x - drift * m) ** 2 / m for x, m in zip(sums, steps)) / 3)
    assert (models.drift, models.spread) == (round(drift, 6), round(spread, 6))
    assert ss.with_thresholds(models, held.filter("false")) is None


def test_masked_text_has_no_span_left(edge_docs, edge_rows):
    got = ss.masked(edge_docs, None)
    assert got.columns == edge_docs.columns
    texts = Counter((r.doc_id, r.text) for r in got.collect())
    want = Counter()
    for r in edge_rows:
        text, end, out, runs = r[1], 0, "", []
        for a, _, b in base_spans(text):
            if runs and a < runs[-1][1]:
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        for a, b in runs:
            out, end = out + text[end:a] + "[SECRET]", b
        want[r[0], text if text is None else out + text[end:]] += 1
    assert texts == want
