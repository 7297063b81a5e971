"""Quality rules: repeated lines across the documents of a host, and rules on one text.

Lines are normalised (blanks joined, trimmed, lower case) and hashed; for each host and line
the distinct documents are counted, exact copies of a text counting once. A line found in
more documents than ``max(min_docs, max_share * documents of the host)`` is removed; above
``WIDE_HOST`` documents the limit grows with the root of their number only, so that a line in
a few hundredths of a large host goes too. A document left with too few of its words is rejected. Text rules of their own kind come first
(``base_failed``). All in built-in functions; counts are combined before every shuffle, so a
line that a third of all documents share is one row per task.

Nulls: a NULL text has no words and fails the base rules; a NULL host is a host of its own.
Empty tables give empty results; repeated rows are judged alike and all returned; extra
columns of any name are kept or dropped with their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.llm.common import BLANK_CHARS, BLANKS, bind, fresh, in_place, settled, text_of, words_of

WINDOW = 5
#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_PERCENT = 20
MIN_DOCS = 20
MAX_SHARE = 0.05
#: Distinct documents of a host up to which its limit is a share of them.
WIDE_HOST = 1_000
#: Frequent lines of a host are looked up by their hash in so many lists.
LISTS = 128
MIN_LEFT_WORDS = 10
MIN_LEFT_SHARE = 0.2


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def filled_lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "")


def repeated_window_words(words: Column, hashes: Column, in_order: Column) -> Column:
    """How many words lie in windows that occur twice or more.

    ``hashes`` are those of all windows by position, ``in_order`` the same sorted. Texts
    without equal neighbours in order end there; the others sort positions by hash, keep
    those with an equal neighbour and add up what each covers up to the next.
    """
    by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]),
        )
        at = F.sort_array(F.transform(again, lambda p: p["i"]))
        return bind(
            at,
            lambda at: F.aggregate(
                F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda a, x: a + x,
            ),
        )

    twice = F.exists(
        F.sequence(F.lit(1), F.size(in_order) - 1), lambda k: F.get(in_order, k) == F.get(in_order, k - 1)
    )
    return F.when(F.size(hashes) < 2, F.lit(0).cast("long")).when(twice, bind(by_hash, covered)).otherwise(F.lit(0).cast("long"))


def text_figures(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns and, of the text ``_text``: its lines with a word (``_l``),
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    base = docs.select(*carried, "_text", words_of(F.col("_text")).alias("_w"), filled_lines(F.col("_text")).alias("_l"))
    base = base.select(
        *carried, "_text", "_l", F.size("_w").cast("long").alias("n_words"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_w"),
    )
    at = lambda i, k: F.get("_w", i + k)
    base = base.withColumn(
        "_h",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_w") - WINDOW),
                lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    base = base.withColumn("_o", F.sort_array("_h"))
    return base.select(
        *carried, "_text", "_l", "n_words",
        F.length(without(F.col("_text"), BLANK_CHARS)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_w"), F.col("_h"), F.col("_o")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def normal_line(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, f"[{BLANKS}]+", " "), F.lit(" ")))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def document_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """``_host, _line`` (hash of the normalised line) and ``_text_hash`` of the lines with a word;
    a line twice in a document is one row."""
    text = text_of()
    return docs.select(
        F.col(f"`{host}`").cast("string").alias("_host"), F.xxhash64(text).alias("_text_hash"),
        F.explode(F.array_distinct(F.transform(filled_lines(text), line_hash))).alias("_line"),
    )


def frequent_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS,
                   max_share: float = MAX_SHARE) -> DataFrame:
    """``_host, _line, n_docs`` of the lines above the limit of their host."""
    hosts = docs.select(F.col(f"`{host}`").cast("string").alias("_host"), F.xxhash64(text_of()).alias("_text_hash"))
    sizes = hosts.distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"))
    counts = (
        document_lines(docs, host).distinct()
        .groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > min_docs)
    )
    return (
        counts.alias("c").join(sizes.alias("s"), F.col("c._host").eqNullSafe(F.col("s._host")))
        .filter(F.col("n_docs") > max_share * F.least(F.col("_docs"), F.sqrt(F.col("_docs") * WIDE_HOST)))
        .select("c._host", "_line", "n_docs")
    )


def with_verdict(docs: DataFrame, name: str, host: str = "source", min_docs: int = MIN_DOCS,
                 max_share: float = MAX_SHARE, min_left_words: int = MIN_LEFT_WORDS,
                 min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """The rows with a struct ``name``: the figures of the text, ``left_words``, ``base_failed``,
    ``kept`` and ``left_text``, the text without its frequent lines.

    A host has at most (lines of a document) * (its documents / its limit) frequent lines, which
    grows with the root of its documents. They are one row per host in the shared folder, dealt to
    ``LISTS`` lists by hash, of which each line searches one. Spark knows the size of that table: it
    is sent to all tasks if small, so that no text moves, and joined by a shuffle otherwise.
    """
    of = lambda h: F.pmod(h, F.lit(LISTS))
    frequent = frequent_lines(docs, host, min_docs, max_share)
    frequent = frequent.groupBy("_host", of(F.col("_line")).alias("_list")).agg(F.collect_list("_line").alias("_lines"))
    frequent = frequent.groupBy("_host").agg(F.map_from_entries(F.collect_list(F.struct("_list", "_lines"))).alias("_gone"))
    frequent = settled(frequent, "frequent-lines").withColumnRenamed("_host", "_frequent_host")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of().alias("_text"),
        F.col(f"`{host}`").cast("string").alias("_host"),
    )
    rows = rows.join(frequent, F.col("_host").eqNullSafe(F.col("_frequent_host")), "left").select("_row", "_gone", "_text")
    out = text_figures(rows, ["_row", "_gone"])
    found = lambda h: F.coalesce(F.array_contains(F.try_element_at("_gone", of(h)), h), F.lit(False))
    gone = lambda line: bind(line_hash(line), found)
    words = lambda line: (F.length(line) - F.length(without(line, " ")) + 1).cast("long")
    removed = F.aggregate(
        F.filter("_l", gone), F.lit(0).cast("long"), lambda a, x: a + words(normal_line(x))
    )
    blank = lambda line: F.btrim(line, F.lit(BLANK_CHARS)) == ""
    left_text = F.array_join(F.filter(F.split("_text", "\n"), lambda x: blank(x) | ~gone(x)), "\n")
    out = out.withColumn("left_words", F.col("n_words") - F.when(F.col("_gone").isNull(), F.lit(0).cast("long")).otherwise(removed))
    depleted = (F.col("left_words") < min_left_words) | (F.col("left_words") < min_left_share * F.col("n_words"))
    verdict = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "left_words",
        base_failed().alias("base_failed"), in_place(~base_failed() & ~depleted).alias("kept"),
        F.when(F.col("left_words") < F.col("n_words"), left_text).otherwise(F.col("_text")).alias("left_text"),
    )
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns], verdict.alias(name))


def cleaned(docs: DataFrame, **limits) -> DataFrame:
    """The documents kept, without their frequent lines; ``n_chars``, if there, follows."""
    name = fresh(docs, "_verdict")
    v = F.col(name)
    out = with_verdict(docs, name, **limits).filter(v["kept"])
    changed = v["left_words"] < v["n_words"]
    new = {"text": F.when(changed, v["left_text"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(v["left_text"]).cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])
