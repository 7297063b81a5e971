"""Collocations: phrases of two to four words, counted in counting quotient filters.

Texts become blocks of words by language, and words found often enough get numbers. Phrases are
counted level by level: a phrase can be frequent only if the phrases in it are, so after each
level a block keeps the runs of words whose phrases are all frequent. The numbers of a phrase are
packed into one number of 2h bits and permuted by a Feistel network; its first bits name a shard,
the next the quotient, and all others are kept as the remainder. A filter is therefore lossless:
one bit per quotient, one per counter, the remainders, and counters of one byte that spill into
eight. A block sends each shard one filter; a shard merges the sorted filters, keeps phrases
at or above the least count, and answers every block with those of its phrases that stay.

What a phrase's parts need is counted on the way, as the parts of a frequent phrase are frequent.

A NULL text is empty and a NULL language is ``und``; empty texts and tables give no rows. Repeated
rows count each. Long texts are blocks of their own. Ties in score go to the larger count, then
to the phrase in byte order; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import settled, text_of

LEAST = 30
LONGEST = 4
TOP = 2000
#: A phrase goes if a longer one around it has this share of its count, in hundredths.
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
NO_LANGUAGE = "und"

#: What ends a piece of text, and what parts words inside one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
TAB, SPACE = b"\t", b" "
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
END = b"."  # stands for every end of a piece

TABLE = bytes.maketrans(UPPER + PIECE_ENDS + TAB, LOWER + END * len(PIECE_ENDS) + SPACE)

#: Words a shard has at most, on average.
SHARD_WORDS = 1 << 20
ROUND_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
BYTE_COUNTERS = 255


# ---- counting quotient filters


def mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def low_bits(n: int) -> np.uint64:
    return np.uint64((1 << n) - 1)


def permuted(hi: np.ndarray, lo: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of the numbers of 2h bits, given as halves."""
    for key in ROUND_KEYS:
        hi, lo = lo, hi ^ (mixed(lo, key) & low_bits(h))
    return hi, lo


def restored(hi: np.ndarray, lo: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(ROUND_KEYS):
        hi, lo = lo ^ (mixed(hi, key) & low_bits(h)), hi
    return hi, lo


def packed(grams: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of word numbers of ``w`` bits as halves of h bits."""
    n = grams.shape[1]
    half = -(-n // 2)
    parts = []
    for columns in (grams[:, :half], grams[:, half:]):
        x = np.zeros(len(grams), dtype=np.uint64)
        for c in range(columns.shape[1]):
            x = (x << np.uint64(w)) | columns[:, c].astype(np.uint64)
        parts.append(x)
    return parts[0], parts[1], half * w


def unpacked(hi: np.ndarray, lo: np.ndarray, n: int, w: int) -> np.ndarray:
    half = -(-n // 2)
    out = np.zeros((len(hi), n), dtype=np.int64)
    for first, last, x in ((0, half, hi), (half, n, lo)):
        for c in range(last - 1, first - 1, -1):
            out[:, c] = (x & low_bits(w)).astype(np.int64)
            x = x >> np.uint64(w)
    return out


def top_bits(hi: np.ndarray, lo: np.ndarray, h: int, t: int) -> np.ndarray:
    """The first ``t`` of 2h bits."""
    if t <= h:
        return hi >> np.uint64(h - t) if t else np.zeros_like(hi)
    return (hi << np.uint64(t - h)) | (lo >> np.uint64(2 * h - t))


def in_order(hi: np.ndarray, lo: np.ndarray, h: int) -> np.ndarray:
    if 2 * h <= 64:
        return np.argsort((hi << np.uint64(h)) | lo, kind="stable")
    return np.lexsort((lo, hi))


def summed(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, h: int) -> tuple[np.ndarray, ...]:
    """Distinct numbers in order with their total counts; and of each given one, its place there."""
    order = in_order(hi, lo, h)
    a, b = hi[order], lo[order]
    first = np.ones(len(a), dtype=bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(a), dtype=np.int64)
    place[order] = np.cumsum(first) - 1
    totals = np.add.reduceat(counts[order], np.flatnonzero(first)) if len(a) else counts[:0]
    return a[first], b[first], totals, place


HEADER = struct.Struct("<BBBQ")


def filter_of(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, h: int, s: int) -> bytes:
    """The filter of permuted numbers, distinct and in order, that agree in their first ``s`` bits."""
    n = len(hi)
    q = min(max(1, n.bit_length()), 2 * h - s, 30)
    t = s + q
    quotient = top_bits(hi, lo, h, t) & low_bits(q)
    occupied = np.zeros(1 << q, dtype=np.uint8)
    occupied[quotient] = 1
    ends = np.ones(n, dtype=np.uint8)
    ends[:-1] = quotient[1:] != quotient[:-1]
    shard = int(top_bits(hi[:1], lo[:1], h, s)[0]) if n else 0
    rest = []
    for x, bits in ((hi, max(0, h - t)), (lo, min(h, 2 * h - t))):
        x = np.ascontiguousarray(x & low_bits(bits)).view(np.uint8).reshape(n, 8)
        rest.append(x[:, :-(-bits // 8)].tobytes())
    small = np.minimum(counts, BYTE_COUNTERS).astype(np.uint8)
    large = counts[counts >= BYTE_COUNTERS].astype("<i8")
    return b"".join([HEADER.pack(h, s, q, n), struct.pack("<Q", shard), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                     *rest, small.tobytes(), large.tobytes()])


def entries_of(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """What a filter holds: permuted numbers in order, their counts, and h."""
    h, s, q, n = HEADER.unpack_from(blob)
    (shard,) = struct.unpack_from("<Q", blob, HEADER.size)
    at = HEADER.size + 8
    t = s + q

    def read(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(blob, dtype=np.uint8, count=size, offset=at - size)

    occupied = np.flatnonzero(np.unpackbits(read(-(-(1 << q) // 8)), count=1 << q))
    ends = np.unpackbits(read(-(-n // 8)), count=n)
    run = np.cumsum(ends) - ends
    top = (np.uint64(shard) << np.uint64(q)) | occupied[run].astype(np.uint64)
    halves = []
    for bits in (max(0, h - t), min(h, 2 * h - t)):
        wide = np.zeros((n, 8), dtype=np.uint8)
        size = -(-bits // 8)
        wide[:, :size] = read(n * size).reshape(n, size)
        halves.append(wide.reshape(-1).view(np.uint64))
    if t <= h:
        hi, lo = halves[0] | (top << np.uint64(h - t)), halves[1]
    else:
        hi, lo = top >> np.uint64(t - h), halves[1] | ((top & low_bits(t - h)) << np.uint64(2 * h - t))
    counts = read(n).astype(np.int64)
    spilled = counts == BYTE_COUNTERS
    counts[spilled] = np.frombuffer(blob, dtype="<i8", count=int(spilled.sum()), offset=at)
    return hi, lo, counts, h


def merged(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, list[np.ndarray]]:
    """The sum of sorted filters of one shard, and where each filter's entries went."""
    parts = [entries_of(f) for f in filters]
    h = parts[0][3]
    hi, lo, totals, place = summed(*(np.concatenate([p[i] for p in parts]) for i in range(3)), h)
    return hi, lo, totals, h, np.split(place, np.cumsum([len(p[0]) for p in parts])[:-1])


# ---- blocks of words


BLOCK_DDL = "lang string, words array<string>, counts array<bigint>, codes binary"


def blocks_of(docs: DataFrame) -> DataFrame:
    """``block`` and the columns of ``BLOCK_DDL``: ``codes`` are numbers from 1 in ``words``, 0 an end."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                data = END.decode().join(some).encode().translate(TABLE)
                tokens = data.replace(END, SPACE + END + SPACE).split()
                known = {w: i for i, w in enumerate(dict.fromkeys(chain([END], tokens)))}
                codes = np.fromiter(map(known.__getitem__, tokens), dtype="<i4", count=len(tokens))
                words = pa.array(list(known)[1:], pa.binary()).cast(pa.string())
                counts = np.bincount(codes, minlength=len(known))[1:]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang]), pa.ListArray.from_arrays([0, len(words)], words),
                    pa.ListArray.from_arrays([0, len(words)], pa.array(counts, pa.int64())), pa.array([codes.tobytes()]),
                ], names=["lang", "words", "counts", "codes"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)), text_of())
    return settled(rows.mapInArrow(read, BLOCK_DDL).withColumn("block", F.monotonically_increasing_id()), "word-blocks")


def numbered(blocks: DataFrame, least: int) -> tuple[DataFrame, int]:
    """``id, lang, word, f`` of words found ``least`` times or more, and how many they are.

    The driver sees one count per partition of them.
    """
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    totals = each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    often = totals.filter(F.col("f") >= least)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    often = settled(often.select("lang", "word", "f", F.spark_partition_id().alias("part"), inside.alias("nth")), "words")
    sizes = sorted((r["part"], r["n"]) for r in often.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)])
    starts = often.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], "part int, start bigint")
    words = often.join(F.broadcast(starts), "part").select((F.col("start") + F.col("nth") + 1).alias("id"), "lang", "word", "f")
    return settled(words, "numbered-words"), int(before[-1])


def runs(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The stretches of ``ids`` whose phrases of ``n`` words all start at a marked place, each before a 0."""
    edges = np.diff(np.concatenate([[False], starts, [False]]).astype(np.int8))
    first, size = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1) + n
    out = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    kept = ids[np.minimum(out, len(ids) - 1)]
    kept[np.cumsum(size) - 1] = 0
    return kept


def phrases(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where ``n`` words follow each other without an end, and their numbers."""
    if len(ids) < n:
        return np.empty(0, dtype=np.int64), np.empty((0, n), dtype=ids.dtype)
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    at = np.flatnonzero((windows != 0).all(axis=1))
    return at, windows[at]


RUN_DDL = "block bigint, ids binary"


def encoded(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """``block, ids``: runs of frequent words by number, each before a 0."""
    asked = blocks.select("block", "lang", F.posexplode("words").alias("i", "word"))
    known = asked.join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("block").agg(F.collect_list("i").alias("i"), F.collect_list("id").alias("id"))
    rows = known.hint("merge").join(blocks.select("block", "codes"), "block").select("block", "codes", "i", "id")

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                codes = np.frombuffer(batch.column("codes")[r].as_py(), dtype="<i4")
                i, number = (batch.column(c)[r].values.to_numpy() for c in ("i", "id"))
                lookup = np.zeros(int(max(codes.max(initial=0), i.max(initial=0) + 1)) + 1, dtype="<u4")
                lookup[i + 1] = number
                ids = lookup[codes]
                out.append(runs(ids, ids != 0, 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "ids"])

    return settled(rows.mapInArrow(numbers, RUN_DDL), "word-numbers")


# ---- levels


def sent(blocks: DataFrame, n: int, w: int, s: int) -> DataFrame:
    """``shard, block, filter``: each block's phrases of ``n`` words, one filter per shard."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[r].as_py(), dtype="<u4")
                hi, lo, h = packed(phrases(ids, n)[1], w)
                hi, lo = permuted(hi, lo, h)
                hi, lo, counts, _ = summed(hi, lo, np.ones(len(hi), dtype=np.int64), h)
                shard = top_bits(hi, lo, h, s).astype(np.int64)
                edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
                spans = [(a, b) for a, b in zip(edges, edges[1:]) if b > a]
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(shard[a]) for a, _ in spans], pa.int64()), pa.array([batch.column("block")[r].as_py()] * len(spans), pa.int64()),
                    pa.array([filter_of(hi[a:b], lo[a:b], counts[a:b], h, s) for a, b in spans], pa.binary()),
                ], names=["shard", "block", "filter"])

    return blocks.mapInArrow(count, "shard bigint, block bigint, filter binary")


def counted(filters: DataFrame, least: int, s: int) -> DataFrame:
    """``block, filter``: with no block, the frequent phrases of a shard; else those of a block."""

    def merge(table: pa.Table) -> pa.Table:
        owners, blobs = table.column("block").to_pylist(), table.column("filter").to_pylist()
        hi, lo, totals, h, places = merged(blobs)
        often = totals >= least
        out = [(None, filter_of(hi[often], lo[often], totals[often], h, s))] if often.any() else []
        for owner, place in zip(owners, places):
            at = place[often[place]]
            if len(at):
                out.append((owner, filter_of(hi[at], lo[at], totals[at], h, s)))
        return pa.table({"block": pa.array([b for b, _ in out], pa.int64()), "filter": pa.array([f for _, f in out], pa.binary())})

    return settled(filters.groupBy("shard").applyInArrow(merge, "block bigint, filter binary"), "phrase-filters")


def listed(answers: DataFrame, n: int, w: int) -> DataFrame:
    """``ids, f``: the frequent phrases by word numbers."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                hi, lo, totals, h = entries_of(blob)
                grams = unpacked(*restored(hi, lo, h), n, w)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(np.arange(0, n * len(grams) + 1, n, dtype=np.int32), pa.array(grams.reshape(-1))), pa.array(totals),
                ], names=["ids", "f"])

    return answers.filter("block IS NULL").select("filter").mapInArrow(read, "ids array<bigint>, f bigint")


def narrowed(blocks: DataFrame, answers: DataFrame, n: int, w: int) -> DataFrame:
    """The runs of each block whose phrases of ``n`` words are all frequent."""
    mine = answers.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list("filter").alias("filters"))
    rows = mine.hint("merge").join(blocks, "block").select("block", "ids", "filters")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[r].as_py(), dtype="<u4")
                at, grams = phrases(ids, n)
                hi, lo, h = packed(grams, w)
                hi, lo = permuted(hi, lo, h)
                known = [entries_of(f) for f in batch.column("filters")[r].as_py()]
                k_hi, k_lo = (np.concatenate([p[i] for p in known]) for i in range(2))
                marks = np.concatenate([np.zeros(len(hi), dtype=np.int64), np.ones(len(k_hi), dtype=np.int64)])
                _, _, found, place = summed(np.concatenate([hi, k_hi]), np.concatenate([lo, k_lo]), marks, h)
                starts = np.zeros(len(ids), dtype=bool)
                starts[at] = found[place[:len(hi)]] > 0
                out.append(runs(ids, starts, n).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "ids"])

    return settled(rows.mapInArrow(keep, RUN_DDL), "phrase-runs")


def frequent(blocks: DataFrame, words: DataFrame, n_words: int, least: int, longest: int) -> DataFrame:
    """``ids, f`` of all phrases of one to ``longest`` words found ``least`` times or more."""
    spark = blocks.sparkSession
    w = max(1, n_words.bit_length())
    if w > 32:
        raise ValueError("more frequent words than 32 bits can number")
    out = words.select(F.array("id").alias("ids"), "f")
    now = encoded(blocks, words)
    for n in range(2, longest + 1):
        size = (now.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // 4
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_WORDS)
        s = min((shards - 1).bit_length(), 2 * w)
        answers = counted(sent(now, n, w, s), least, s)
        out = out.unionByName(listed(answers, n, w))
        if n < longest:
            now = narrowed(now, answers, n, w)
    return settled(out, "phrases")


# ---- scores


def scored(grams: DataFrame) -> DataFrame:
    """``ids, a, l, r, score`` of phrases at their lowest-scoring cut, smaller cuts first."""
    cuts = grams.filter("size(ids) > 1").select("ids", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("_l"), F.expr("slice(ids, k + 1, size(ids))").alias("_r"))
    cuts = cuts.join(grams.select(F.col("ids").alias("_l"), F.col("f").alias("l")), "_l")
    cuts = cuts.join(grams.select(F.col("ids").alias("_r"), F.col("f").alias("r")), "_r")
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    cuts = cuts.withColumns({"_up": a * F.lit(SCORE_SCALE).cast("decimal(7,0)"), "_down": l + r})
    score = F.expr("CAST(_up div _down AS BIGINT)")
    low = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return low.select("ids", "a", "c.l", "c.r", "c.score")


def uncovered(grams: DataFrame, share: int) -> DataFrame:
    """``ids`` of phrases that no longer phrase around them covers."""
    longer = grams.filter("size(ids) > 2").select(F.col("f").alias("_f"), F.expr(
        "explode(flatten(transform(sequence(2, size(ids) - 1), n -> transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n)))))"
    ).alias("ids"))
    most = longer.groupBy("ids").agg(F.max("_f").alias("_f"))
    a, f = (F.col(c).cast("decimal(19,0)") for c in ("f", "_f"))
    rows = grams.filter("size(ids) > 1").join(most, "ids", "left")
    return rows.filter(F.col("_f").isNull() | (f * 100 < a * share)).select("ids")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    blocks = blocks_of(docs)
    words, n_words = numbered(blocks, least)
    grams = frequent(blocks, words, n_words, least, longest)
    kept = settled(scored(grams).join(uncovered(grams, covered), "ids"), "scored-phrases")

    spelled = kept.select("ids", F.posexplode("ids").alias("i", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    spelled = spelled.select("ids", "lang", F.array_join(F.col("w.word"), " ").alias("phrase"))
    rows = kept.join(spelled, "ids").drop("ids")

    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    parts = min(256, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = rows.withColumn("_salt", salt)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = blocks.select("lang", F.expr("aggregate(counts, 0L, (x, y) -> x + y)").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    out = best.join(sizes, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
