"""Secret scans: fixed patterns, and two character Markov models compared by likelihood ratio.

Patterns find assignments, access keys and long hexadecimal runs. Beside them, unbroken tokens
of 12 characters or more are scored under a model of random strings and one of ordinary
identifiers (order-1 transitions, smoothed); a token whose log-likelihood ratio passes the
threshold of its length is a span of kind ``markov``. Tokens with fewer than two letters are
numbers, dates or times, which the ordinary class does not hold; they are not scored.

The models learn from labelled tokens: values the patterns found, and words of ordinary text. At
most ``MAX_RANDOM`` and ``MAX_ORDINARY`` tokens, the smallest by hash, are used, the ordinary
ones out of at most ``ORDINARY_DOCS`` documents; these bound the fit alone, and every token of
every text is scored. The transition counts are at most 2 x 68 x 68 numbers.

One ordinary token in ``HELD_OUT`` is kept from the counts. Over ``m`` transitions the ratio of
these goes about ``drift * m``, with deviations of ``spread * sqrt(m)``; a threshold lies
``DEVIATIONS`` of them above, and never below ``MIN_RATIO``.

A span's place follows from the lengths of what lies between the matches of its kind, added
up over the rows of one text. All in built-in functions. Spans count code points, the end is
exclusive; ``markov`` spans may overlap others.

Nulls: a NULL text is empty; NULL ids are kept. Repeated rows each get their spans. Without
labelled tokens of either class, or without held-out ones, no ``markov`` span is found. Empty and long texts are ordinary
cases, and an empty table gives no rows. ``masked`` keeps all columns, whatever their names;
``scan`` reads the id and the text only. Spans that begin at one place are listed by kind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import bind, fresh, settled, text_of

#: The patterns of the three base kinds, in the order of the listing. Runs
#: shorter than asked for cannot hold a longer one, so their minimum stands in the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "markov")

TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
TWO_LETTERS = r"[A-Za-z][^A-Za-z]*[A-Za-z]"
ORDINARY = r"[A-Za-z][A-Za-z0-9_-]{4,}"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SMOOTHING = 0.5
#: A random string must be a thousand times as likely.
MIN_RATIO = math.log(1000.0)
DEVIATIONS = 5.0
HELD_OUT = 5
MAX_RANDOM = 20_000
MAX_ORDINARY = 20_000
ORDINARY_DOCS = 2_000


@dataclass(frozen=True)
class Models:
    """``ratio[a * width + b]``: log of the odds, random to ordinary, of ``b`` after ``a``;
    ``drift`` and ``spread`` of the ratio of ordinary tokens per transition."""

    ratio: tuple[float, ...]
    width: int
    drift: float = 0.0
    spread: float = 0.0


def found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def labelled_tokens(docs: DataFrame, max_random: int = MAX_RANDOM, max_ordinary: int = MAX_ORDINARY,
                    ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """``token, random`` (1 or 0): values the patterns found, and words of some documents.

    Only distinct tokens are taken, the smallest by hash up to the stated numbers.
    """
    text = text_of()
    values = F.concat(
        F.filter(found(text, ASSIGN, 1), lambda x: F.length(x) >= MIN_ASSIGNED), found(text, ACCESS), found(text, HEX)
    )

    def some(tokens: DataFrame, most: int) -> DataFrame:
        tokens = tokens.distinct().withColumn("_h", F.xxhash64("token"))
        return tokens.orderBy("_h", "token").limit(most).select("token")

    random = some(docs.select(F.explode(values).alias("token")), max_random)
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(ordinary_docs)
    chosen = docs.select("doc_id", text.alias("_t")).join(F.broadcast(ids), "doc_id", "left_semi")
    plain = F.regexp_replace(F.regexp_replace(F.col("_t"), ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    words = some(chosen.select(F.explode(found(plain, ORDINARY)).alias("token")), max_ordinary)
    return random.withColumn("random", F.lit(1)).unionByName(words.withColumn("random", F.lit(0)))


def train(labelled: DataFrame, smoothing: float = SMOOTHING) -> Models | None:
    """Both models from tokens with a label, and the thresholds from those held out; None if a
    class has no transition, or no ordinary token is held out."""
    labelled = settled(labelled, "labelled-tokens")
    held = (F.col("random") == 0) & (F.pmod(F.xxhash64("token", F.lit("held out")), F.lit(HELD_OUT)) == 0)
    models = transitions(labelled.filter(~held), smoothing)
    return models and with_thresholds(models, labelled.filter(held))


def with_thresholds(models: Models, held: DataFrame) -> Models | None:
    """The models with drift and spread of the ratio of ordinary tokens they have not seen."""
    known = held.filter(F.length("token") > 1).filter(F.col("token").rlike(r"^[A-Za-z0-9+/_=-]+$"))
    rows = known.select(ratio(F.col("token"), models).alias("x"), (F.length("token") - 1).alias("m"))
    n, x, m, squares = rows.agg(
        F.count(F.lit(1)), F.sum("x"), F.sum("m"), F.sum(F.col("x") * F.col("x") / F.col("m"))
    ).first()
    if not n:
        return None
    drift = x / m
    spread = math.sqrt(max(squares - 2 * drift * x + drift * drift * m, 0.0) / n)
    return replace(models, drift=round(drift, 6), spread=round(spread, 6))


def transitions(labelled: DataFrame, smoothing: float) -> Models | None:
    chars = F.split("token", "")
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("c") - 1), lambda k: F.concat(F.get("c", k - 1), F.get("c", k))
    )
    counts = (
        labelled.filter(F.length("token") > 1).select("random", chars.alias("c"))
        .select("random", F.explode(pairs).alias("pair"))
        .groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    )
    known = set(SYMBOLS)
    n: dict[tuple[int, str], int] = {}
    for row in counts.filter(F.length("pair") == 2).filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).collect():
        n[row["random"], row["pair"]] = row["n"]
    if not all(any(k[0] == c for k in n) for c in (0, 1)):
        return None
    width = len(known)
    total = {(c, a): sum(n.get((c, a + b), 0) for b in SYMBOLS) for c in (0, 1) for a in SYMBOLS}

    def log_p(c: int, a: str, b: str) -> float:
        return math.log((n.get((c, a + b), 0) + smoothing) / (total[c, a] + smoothing * width))

    return Models(tuple(round(log_p(1, a, b) - log_p(0, a, b), 6) for a in SYMBOLS for b in SYMBOLS), width)


def ratio(token: Column, models: Models) -> Column:
    """Log-likelihood ratio of a token's transitions, random against ordinary."""
    table = F.split(F.lit(",".join(map(str, models.ratio))), ",").cast("array<double>")
    place = [0] * 128
    for i, s in enumerate(SYMBOLS):
        place[ord(s)] = i
    places = F.split(F.lit(",".join(map(str, place))), ",").cast("array<int>")
    codes = F.transform(F.split(token, ""), lambda c: F.get(places, F.ascii(c)))
    add = lambda codes: F.aggregate(
        F.sequence(F.lit(1), F.size(codes) - 1), F.lit(0.0),
        lambda a, k: a + F.get(table, F.get(codes, k - 1) * models.width + F.get(codes, k)),
    )
    return bind(codes, add)


def is_random(token: Column, models: Models) -> Column:
    """Whether the ratio of a token passes the threshold of its length."""
    m = (F.length(token) - 1).cast("double")
    threshold = F.greatest(F.lit(MIN_RATIO), m * models.drift + F.sqrt(m) * (DEVIATIONS * models.spread))
    return F.when(token.rlike(TWO_LETTERS), ratio(token, models) >= threshold).otherwise(False)


def lengths(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.length(x))


def span_rows(docs: DataFrame, models: Models | None) -> DataFrame:
    """One row per span: ``_id, _t`` (hash of the text), ``_kind`` (its number), ``start, end``."""
    base = docs.select(F.col("doc_id").alias("_id"), text_of().alias("_text"))
    patterns = [ASSIGN, ACCESS, HEX, TOKEN] if models else [ASSIGN, ACCESS, HEX]
    base = base.select(
        "_id", "_text", F.xxhash64("_text").alias("_t"),
        *[found(F.col("_text"), p).alias(f"_m{k}") for k, p in enumerate(patterns)],
    )
    good = [
        F.transform("_m0", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= MIN_ASSIGNED),
        F.transform("_m1", lambda m: F.lit(True)),
        F.transform("_m2", lambda m: F.lit(True)),
    ]
    if models:
        good.append(F.transform("_m3", lambda m: is_random(m, models)))
    base = base.select("_id", "_t", "_text", *[f"_m{k}" for k in range(len(patterns))],
                       *[g.alias(f"_g{k}") for k, g in enumerate(good)])
    each = [
        F.when(
            F.exists(f"_g{k}", lambda g: g),
            F.struct(
                F.lit(k).alias("_kind"),
                F.arrays_zip(
                    lengths(F.split("_text", p, -1)).alias("between"), lengths(F.col(f"_m{k}")).alias("hit"),
                    F.col(f"_g{k}").alias("good"),
                ).alias("_parts"),
            ),
        )
        for k, p in enumerate(patterns)
    ]
    kinds = base.select("_id", "_t", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("_x"))
    parts = kinds.select("_id", "_t", "_x._kind", F.posexplode("_x._parts").alias("_i", "_p"))
    parts = parts.filter(F.col("_p.hit").isNotNull()).distinct()
    upto = Window.partitionBy("_id", "_t", "_kind").orderBy("_i")
    end = F.sum((F.col("_p.between") + F.col("_p.hit")).cast("long")).over(upto)
    return (
        parts.withColumn("end", end).withColumn("start", F.col("end") - F.col("_p.hit"))
        .filter("_p.good").select("_id", "_t", "_kind", "start", "end")
    )


def listed(spans: Column, base_only: bool) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    if base_only:
        spans = F.filter(spans, lambda s: s["_kind"] < 3)
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["_kind"]), s["start"], s["end"])), ","
    )


def scan(docs: DataFrame, models: Models | None) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans``."""
    per_doc = span_rows(docs, models).groupBy("_id", "_t").agg(
        F.sort_array(F.collect_list(F.struct("start", "_kind", "end"))).alias("_s")
    )
    keys = docs.select(F.col("doc_id"), F.xxhash64(text_of()).alias("_k"))
    out = keys.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_t")), "left")
    none = F.array().cast("array<struct<start:bigint,_kind:int,end:bigint>>")
    out = out.select("doc_id", F.coalesce("_s", none).alias("_s"))
    count = lambda k: F.size(F.filter("_s", lambda s: s["_kind"] == k)).cast("long")
    return out.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(F.col("_s"), True), 256).alias("base_sha256"), listed(F.col("_s"), False).alias("spans"),
    )


def masked(docs: DataFrame, models: Models | None, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span, overlapping ones as one, replaced by ``mask``.

    ``n_chars``, if there, is counted anew in changed texts; other columns stay as they are.
    """
    w = Window.partitionBy("_id", "_t").orderBy("start", "end")
    spans = span_rows(docs, models).withColumn("_upto", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("_run", F.sum((F.coalesce(F.col("start") >= F.col("_upto"), F.lit(True))).cast("int")).over(w))
    runs = spans.groupBy("_id", "_t", "_run").agg(F.min("start").alias("a"), F.max("end").alias("b"))
    runs = runs.groupBy("_id", "_t").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("_s"))
    own, hashed, cuts = (fresh(docs, c) for c in ("_span_id", "_span_t", "_span_s"))
    runs = runs.select(F.col("_id").alias(own), F.col("_t").alias(hashed), F.col("_s").alias(cuts))
    out = docs.join(runs, F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64(text_of()) == F.col(hashed)), "left")
    chars = F.split("text", "")

    def rebuilt(chars: Column) -> Column:
        cut = lambda a, b: F.array_join(F.slice(chars, a + 1, F.greatest(b - a, F.lit(0))), "")
        before = F.transform(
            cuts,
            lambda s, k: F.concat(cut(F.coalesce(F.get(cuts, k - 1)["b"], F.lit(0)).cast("int"), s["a"].cast("int")), F.lit(mask)),
        )
        rest = cut(F.element_at(cuts, -1)["b"].cast("int"), F.size(chars))
        return F.concat(F.array_join(before, ""), rest)

    new = F.when(F.col(cuts).isNull(), F.col("text")).otherwise(
        bind(chars, rebuilt)
    )
    out = out.withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
