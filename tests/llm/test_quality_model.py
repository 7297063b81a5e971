import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brimline.llm import quality_model as qm


def grams(text, order):
    """Tuples of classes that end at each character."""
    s = qm.symbols(text.lower()).tolist()
    return [tuple(s[i - order + 1:i + 1]) for i in range(qm.PAD, len(s))]


class Plain:
    """Interpolated modified Kneser-Ney by dictionaries, order by order."""

    def __init__(self, texts):
        counts = [Counter(g for t in texts for g in grams(t, qm.ORDER))]
        for _ in range(qm.ORDER - 1):
            counts.append(Counter(g[1:] for g in counts[-1]))
        self.levels = []
        for n in counts:
            seen = Counter(n.values())
            d = qm.discounts([seen[k] for k in range(1, 5)])
            total, off = Counter(), defaultdict(float)
            for g, c in n.items():
                total[g[:-1]] += c
                off[g[:-1]] += d[min(c, 3)]
            self.levels.append((n, d, total, off))

    def p(self, gram, level=0):
        if level == qm.ORDER:
            return 1 / qm.CLASSES
        n, d, total, off = self.levels[level]
        lower = self.p(gram[1:], level + 1)
        context = gram[:-1]
        if context not in total:
            return lower
        c = n.get(gram, 0)
        return (c - d[min(c, 3)] + off[context] * lower) / total[context]

    def loss(self, text):
        return -sum(math.log(self.p(g)) for g in grams(text, qm.ORDER))


def labels_of(spark, ids):
    return spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("block", [500, 10**6])
def test_losses_equal_plain_model(spark, documents, block):
    rows = {r.doc_id: r.text for r in documents.collect()}
    good = sorted(rows)[:12]
    model = qm.fit(documents, labels_of(spark, good))
    plain = Plain([rows[i] for i in good])
    asked = documents.filter(F.length("text") < 900)
    got = {r.doc_id: (r.n_chars, r.loss) for r in qm.losses(asked, *model, block_chars=block).collect()}
    assert set(got) == {i for i, t in rows.items() if len(t) < 900} and len(got) > 30
    for i, (n, loss) in got.items():
        assert n == len(rows[i])
        assert loss == pytest.approx(plain.loss(rows[i]), rel=1e-5)


def test_probabilities_sum_to_one(spark, documents):
    texts = [r.text for r in documents.limit(5).collect()]
    plain = Plain(texts)
    for g in grams(texts[0], qm.ORDER)[:200:10]:
        assert sum(plain.p((*g[:-1], w)) for w in range(qm.CLASSES)) == pytest.approx(1.0)


def test_held_out_quality(spark):
    """Clean documents outside the training sample stay; most random or shouted text goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = qm.classify(docs, labels, most=500).join(labels, "doc_id")
    got = {(r.quality, r.toxic): r.share for r in out.groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert got[1, 0] > 0.99
    assert got[0, 0] < 0.35


def test_fences_are_exact_quartiles(spark):
    df = spark.createDataFrame([("a", v) for v in range(1, 101)] + [(None, 7), ("b", None)], "lang string, milli bigint")
    got = {r["_lang"]: (r.q1, r.q3) for r in qm.fences(df).collect()}
    assert got == {"a": (25, 75), None: (7, 7)}


def test_share_of_junk_does_not_move_the_fence(spark):
    """Languages with 35 % junk, one without labels: before, their third quartile was a junk
    score and all junk stayed."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality", "toxic")
    clean = docs.join(qm.good(labels), "doc_id").filter("lang = 'en' and length(text) > 300").orderBy("doc_id").limit(1300)
    r = random.Random(3)
    chars = "abcdefghijklmnopqrstuvwxyz 0123456789#$%&"
    junk = [(-1 - i, "".join(r.choice(chars) for _ in range(r.randint(400, 900))), ("en", "none")[i % 2]) for i in range(700)]
    none = F.col("doc_id") % 2 == 0
    clean = clean.withColumn("lang", F.when(none, "none").otherwise("en"))
    out = qm.classify(clean.unionByName(spark.createDataFrame(junk, clean.schema)), labels.filter(~none)).select(
        "lang", (F.col("doc_id") < 0).alias("junk"), F.col("kept").cast("int").alias("kept")
    )
    got = {(x.lang, x.junk): (x.share, x.n) for x in out.groupBy("lang", "junk").agg(F.avg("kept").alias("share"), F.count("*").alias("n")).collect()}
    for lang in ("en", "none"):
        assert got[lang, True][1] > 0.34 * (got[lang, True][1] + got[lang, False][1])
        assert got[lang, True][0] < 0.02 and got[lang, False][0] > 0.97


def test_edges(spark, edge_docs, edge_rows, no_docs, documents):
    out = qm.classify(edge_docs, labels_of(spark, [4, 6]))
    got = Counter((r.doc_id, r.lang, r.n_chars) for r in out.collect())
    assert got == Counter((r[0], r[2], len((r[1] or "").lower())) for r in edge_rows)
    assert out.filter("n_chars = 0 and (kept or perplexity is not null)").count() == 0
    assert out.filter("n_chars > 0 and perplexity is null").count() == 0
    none = labels_of(spark, [])
    assert qm.classify(edge_docs, none).filter("kept").count() == sum(bool(r[1]) for r in edge_rows)
    assert qm.classify(no_docs, labels_of(spark, [1])).count() == 0


def test_model_counts_every_trusted_document(spark):
    """Over 20,000 trusted documents: before, only that many were counted."""
    n, texts = 20_500, ["ab ab", "xyz", "the cat", ""]
    docs = spark.range(n + 500).selectExpr("id as doc_id", "'en' as lang").withColumn("text", F.element_at(F.array(*map(F.lit, texts)), F.expr("cast(doc_id % 4 as int) + 1")))
    ids = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    shards, _ = qm.fit(docs, ids.union(ids))
    got = Counter()
    for r in shards.collect():
        codes, counts = qm.merged([bytes(r.codes)], [bytes(r.counts)])
        got.update(dict(zip(codes.tolist(), counts.tolist())))
    code = lambda g: sum(c << (qm.BITS * k) for k, c in enumerate(reversed(g)))
    want = Counter()
    for k, t in enumerate(texts):
        want.update({code(g): n // 4 * times for g, times in Counter(grams(t, qm.ORDER)).items()})
    assert got == want


@pytest.mark.parametrize("at_once", [2, 3, 100])
def test_counts_are_added_up_in_rounds(spark, at_once):
    one = lambda *v, t: qm.np.array(v, dtype=t).tobytes()
    rows = [(p, s, one(s, s + p + 1, t="<i4"), one(1, p + 1, t="<i8")) for p in range(11) for s in (0, 50)]
    counts = qm.added_up(spark.createDataFrame(rows, "part int, shard int, codes binary, counts binary"), 11, at_once)
    left = counts.collect()
    assert len(left) <= 2 * min(at_once, 11)
    for s in (0, 50):
        codes, n = qm.merged([bytes(r.codes) for r in left if r.shard == s], [bytes(r.counts) for r in left if r.shard == s])
        assert dict(zip(codes.tolist(), n.tolist())) == {s: 11, **{s + p + 1: p + 1 for p in range(11)}}


def test_repeated_text_leaves_mass_to_the_unseen(spark):
    """Many counts of four and few of three: before, D(3+) was zero and a loss infinite."""
    assert qm.discounts([10, 5, 1, 100]).tolist()[3] > 0
    texts = ["abcd efgh ijkl mnop qrst uvwx yz"] * 4 + ["abd"] * 3 + ["xq", "zk zk"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, "abcx yzyz qq dcba"])], "doc_id bigint, text string, lang string")
    model = qm.fit(docs, labels_of(spark, range(len(texts))))
    assert all(math.isfinite(r.loss) for r in qm.losses(docs, *model).collect())
    assert qm.classify(docs, labels_of(spark, range(len(texts)))).filter("perplexity is null").count() == 0


ODD = ["a\0b", "\0\0", "", "🙂🙃 🙂", "￿￾", "中文字符", "привет мир", "x²³ ¼ ٣ 3", "a" * 40, "\U00100000\0"]


def test_symbols_tell_all_characters_apart():
    """Before, characters shared 64 classes: other scripts nine, digits and all beyond U+FFFF one each."""
    of = {tuple(qm.symbols(chr(c))[qm.PAD:].tolist()) for c in range(0x110000) if not 0xD800 <= c < 0xE000}
    assert len(of) == 0x110000 - 0x800
    for text in ODD:
        s = qm.symbols(text)
        assert s[:qm.PAD].tolist() == [0] * qm.PAD and (s[qm.PAD:] > 0).all()
        assert s[qm.PAD:].tobytes().decode("utf-16-le", "surrogatepass").replace(qm.NUL, "\0") == text


@pytest.mark.parametrize("dense", [1, 5000, qm.DENSE])
def test_codes_of_a_block(monkeypatch, dense):
    monkeypatch.setattr(qm, "DENSE", dense)
    r = random.Random(dense)
    texts = [*ODD, "".join(r.choice("ab c\U0001f642Ａ") for _ in range(3000))]
    block = qm.units("".join(qm.escaped(t) for t in texts))
    codes, at = qm.coded(block)
    code = lambda g: sum(c << (qm.BITS * k) for k, c in enumerate(reversed(g)))
    want = [code(s[i - qm.PAD:i + 1]) for s in (qm.symbols(t).tolist() for t in texts) for i in range(qm.PAD, len(s))]
    assert codes.tolist() == sorted(set(want)) and codes[at].tolist() == want and max(want) >= 1 << 63
    assert qm.text_sizes(block).tolist() == [len(qm.symbols(t)) - qm.PAD for t in texts]
    parts = list(qm.by_shard(codes))
    assert sorted(i for _, own in parts for i in own.tolist()) == list(range(len(codes)))
    for _, own in parts:
        assert qm.unpacked(qm.packed(codes[own]), len(own)).tolist() == codes[own].tolist()


def test_losses_of_any_characters_equal_plain_model(spark):
    texts = [*ODD, "привет другой мир 42", "中文字符中文", "🙂🙃🙂 a\0b 43"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang", F.lit("x"))
    good = [0, 3, 4, 5, 6, 7]
    plain = Plain([texts[i] for i in good])
    got = {r.doc_id: (r.n_chars, r.loss) for r in qm.losses(docs, *qm.fit(docs, labels_of(spark, good))).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: len(t) for i, t in enumerate(texts)}
    for i, t in enumerate(texts):
        assert got[i][1] == pytest.approx(plain.loss(t), rel=1e-5)


def test_letters_that_shared_a_class_have_losses_of_their_own(spark):
    """Before, a text of ideographs nine code points on, or of other digits, had the same loss."""
    r = random.Random(5)
    words = ["".join(chr(0x4E00 + r.randrange(400)) for _ in range(3)) for _ in range(20)]
    text = "".join(r.choice(words) for _ in range(400))
    texts = [text, "".join(chr(ord(c) + 9) for c in text), "12 12 12 12", "98 98 98 98"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang", F.lit("x"))
    loss = {x.doc_id: x.loss for x in qm.losses(docs, *qm.fit(docs, labels_of(spark, [0, 2]))).collect()}
    assert loss[1] > 2 * loss[0] and loss[3] > 1.5 * loss[2]
