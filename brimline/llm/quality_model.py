"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The n-grams are of four characters of the text in lower case, all told apart: a symbol is a UTF-16
unit, so a code has 64 bits, and a character beyond U+FFFF is two symbols one after the other. The
model is fitted on all documents labelled as good but those held out. Its counts are kept in shards
by the character before the last, which hold whole contexts and their shorter forms, so orders four
to two of a code are worked out inside one shard; order one is a table of 65,536 numbers.

Documents are read once, in blocks: their characters, compressed, and the distinct codes of a
block are written to the shared folder. The fit meets a block with one bit per document, which
says whether it is trusted, so no text is shuffled by its id (the bits are broadcast up to
``BITS_SENT`` bytes, two million per 16 million documents; beyond, Spark chooses the join). Each task counts the codes of its blocks, and counts are added up in rounds, so
no task meets those of all others. Then the codes of a block go to the shards, joined with their counts
there, and come back as log-probabilities in the order of the codes, and the block, which finds
its codes again in its text, adds them up per document. What travels is one number per distinct
code of a block and not one per character.

A document is kept if its loss per character is at most the upper fence of its language:
the third quartile plus ``FENCE`` times the distance of the quartiles over the trusted documents
of that language held out of the fit (one id in ``HELD_OUT``), exact to a thousandth of a nat, so
that no amount of junk moves it. A language with fewer than ``LEAST_HELD`` of these takes the
clean side of its distinct documents: the median plus the same multiple of its distance from the
first quartile, which junk reaches only when it is the greater half. The mean over few characters varies more, so
``SHORT / sqrt(characters)`` nats are allowed on top.

Nulls: a NULL or empty text has no perplexity and is not kept; a NULL language is a language
of its own. Repeated rows are judged alike. Without trusted text nothing is known: perplexity
is NULL and all documents with text are kept. Very long texts are a block of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import settled, text_of
from brimline.session import scratch_path

ORDER = 4
BITS = 16
CLASSES = 1 << BITS
PAD = ORDER - 1
#: The edge of a text is U+0000; in a text that is written as two units that follow each other in no other.
EDGE = "\0" * PAD
NUL = "\udc00\udc00"
SHARDS = 64
#: Pairs are numbered by a table up to this size, beyond it by sorting.
DENSE = 1 << 25
#: Codes that a task holds before it hands on their counts.
CODES_AT_ONCE = 4_000_000
BLOCK_CHARS = 6_000_000
#: The blocks are written once and shuffled once; a third of a byte per character at this level.
PACK_LEVEL = 9
#: Blocks that one task of a shard answers, and tasks whose counts are added up at once.
BLOCKS_AT_ONCE = 128
#: Bytes of bits that are broadcast to the blocks.
BITS_SENT = 64 << 20
FENCE = 3.0
#: One trusted id in so many is held out, if there are trusted ids for ``LEAST_HELD`` of them.
HELD_OUT = 5
LEAST_HELD = 20
SHORT = 3.0
LEAST_DISCOUNT = 0.1
MILLI = 1000


def escaped(text: str) -> str:
    """A text after its edges."""
    return EDGE + text.replace("\0", NUL)


def units(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), dtype="<u2")


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, after ``PAD`` edges."""
    return units(escaped(text))


def text_sizes(block: np.ndarray) -> np.ndarray:
    """The number of symbols of each of the joined texts."""
    edges = np.flatnonzero(block == 0)
    return np.append(edges[PAD::PAD], len(block)) - edges[PAD - 1::PAD] - 1


def paired(first: np.ndarray, firsts: int, then: np.ndarray, thens: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of numbers under ``firsts`` and ``thens``, as ``first * thens + then`` in
    order, and which of them each pair is."""
    size = firsts * thens
    kind = np.int32 if size < 1 << 31 else np.int64
    key = first.astype(kind) * kind(thens) + then.astype(kind)
    if size > DENSE:
        found, at = np.unique(key, return_inverse=True)
        return found, at.astype(np.int32)
    seen = np.zeros(size, dtype=bool)
    seen[key] = True
    found = np.flatnonzero(seen)
    rank = np.empty(size, dtype=np.int32)
    rank[found] = np.arange(len(found), dtype=np.int32)
    return found, rank[key]


def coded(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes that end at symbols of joined texts, in order, and which of them ends at
    each symbol; edges are left out. Codes grow by one symbol at a time, numbered at each length."""
    own, one = paired(np.zeros(len(block), dtype=np.int32), 1, block, CLASSES)
    own = own.astype(np.uint64)
    codes, at = own, one
    for k in range(1, ORDER):
        first, then = at[:-1], one[k:]
        if k == PAD:
            inside = block[PAD:] > 0
            first, then = first[inside], then[inside]
        found, at = paired(first, len(codes), then, len(own))
        codes = (codes[found // len(own)] << BITS) | own[found % len(own)]
    return codes, at


def by_shard(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The shards of codes and which codes are theirs, in the order given."""
    of = (((codes >> BITS) & (CLASSES - 1)) * 2654435761 >> 7) % SHARDS
    of = of.astype(np.uint8)
    order = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[order], np.arange(SHARDS + 1))
    for s in range(SHARDS):
        if edges[s] < edges[s + 1]:
            yield s, order[edges[s]:edges[s + 1]]


def packed(codes: np.ndarray) -> bytes:
    """Codes in order, as their steps byte by byte, compressed."""
    steps = np.diff(codes, prepend=np.zeros(1, dtype=np.uint64))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", compression_level=PACK_LEVEL).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` codes of :func:`packed`."""
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def good(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()


def marked(texts: DataFrame, ids: DataFrame, n_docs: int) -> DataFrame:
    """``data, size, chosen`` of the blocks that hold documents of ``ids``; ``chosen`` has a bit
    per document of the block. Rows that share an id are all chosen. The blocks have ``n_docs`` documents."""

    def mark(table: pa.Table) -> pa.Table:
        bits = np.zeros(table.column("n")[0].as_py(), dtype=bool)
        bits[table.column("at").to_numpy()] = True
        return pa.table({"block": table.column("block")[:1], "chosen": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    at = texts.select("block", F.size("ids").alias("n"), F.posexplode("ids").alias("at", "doc_id"))
    chosen = at.join(ids, "doc_id", "left_semi").groupBy("block").applyInArrow(mark, "block bigint, chosen binary")
    chosen = settled(chosen, "chosen")
    if n_docs <= 8 * BITS_SENT:
        chosen = F.broadcast(chosen)
    return texts.select("block", "data", "size").join(chosen, "block").drop("block")


def ngram_counts(chosen: DataFrame) -> DataFrame:
    """``part, shard, codes, counts``: counts of the tasks' own texts, not yet added up."""

    def rows(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        part = TaskContext.get().partitionId()
        out = [(part, s, codes[at].tobytes(), n[at].tobytes()) for s, at in by_shard(codes)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            names=["part", "shard", "codes", "counts"],
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        for batch in batches:
            for data, size, bits in zip(*(batch.column(c) for c in ("data", "size", "chosen"))):
                block = characters(data.as_py(), size.as_py())
                lengths = text_sizes(block)
                wanted = np.unpackbits(np.frombuffer(bits.as_py(), dtype=np.uint8), count=len(lengths)).astype(bool)
                found, at = coded(block)
                times = np.bincount(at[np.repeat(wanted, lengths)], minlength=len(found))
                codes, n = added([codes, found[times > 0]], [n, times[times > 0]])
                if len(codes) > CODES_AT_ONCE:
                    yield rows(codes, n)
                    codes, n = codes[:0], n[:0]
        yield rows(codes, n)

    return chosen.mapInArrow(count, "part int, shard int, codes binary, counts binary")


def added_up(counts: DataFrame, parts: int, at_once: int = BLOCKS_AT_ONCE) -> DataFrame:
    """``counts`` of at most ``parts`` tasks added up in rounds, until about ``at_once`` rows of a shard are left."""

    def add(key, table):
        codes, n = merged(table.column("codes").to_pylist(), table.column("counts").to_pylist())
        return pa.table({
            "part": pa.array([key[1].as_py()], pa.int32()), "shard": pa.array([key[0].as_py()], pa.int32()),
            "codes": pa.array([codes.tobytes()]), "counts": pa.array([n.tobytes()]),
        })

    while (parts := math.ceil(parts / at_once)) > 1:
        lane = F.pmod("part", F.lit(parts)).cast("int").alias("lane")
        counts = counts.groupBy("shard", lane).applyInArrow(add, "part int, shard int, codes binary, counts binary")
    return counts


def added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order with their counts added up."""
    out, at = np.unique(np.concatenate(codes), return_inverse=True)
    return out, np.bincount(at, weights=np.concatenate(counts), minlength=len(out)).astype(np.int64)


def merged(codes: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`added`, of the bytes of whole numbers: counts of eight each, codes of eight or four."""
    n = [np.frombuffer(x, dtype=np.int64) for x in counts]
    c = [np.frombuffer(x, dtype=np.uint64 if len(x) == y.nbytes else np.uint32).astype(np.uint64) for x, y in zip(codes, n)]
    return added([np.empty(0, dtype=np.uint64), *c], [np.empty(0, dtype=np.int64), *n])


def shorter(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes without their first character, and how many different ones each had."""
    return np.unique(codes & ((1 << (BITS * (order - 1))) - 1), return_counts=True)


def model_shards(counts: DataFrame) -> DataFrame:
    """One row per shard: its codes and counts, the last symbols with the number of different ones
    before, and how many counts of orders four to two are 1 to 4."""

    def fold(key, table):
        codes, n = merged(table.column("codes").to_pylist(), table.column("counts").to_pylist())
        three, n3 = shorter(codes, 4)
        two, n2 = shorter(three, 3)
        last, before = shorter(two, 2)
        seen = [int((x == k).sum()) for x in (n, n3, n2) for k in range(1, 5)]
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "codes": pa.array([codes.tobytes()]),
            "counts": pa.array([n.tobytes()]), "last": pa.array([last.tolist()], pa.list_(pa.int64())),
            "before": pa.array([before.tolist()], pa.list_(pa.int64())), "seen": pa.array([seen], pa.list_(pa.int64())),
        })

    return counts.groupBy("shard").applyInArrow(
        fold, "shard int, codes binary, counts binary, last array<bigint>, before array<bigint>, seen array<bigint>"
    )


def discounts(n: np.ndarray) -> np.ndarray:
    """D(0) to D(3+) of modified Kneser-Ney from the numbers of counts 1 to 4. The estimates may be
    zero or less (many counts of 4, few of 3, as in large or repeated text); they are held at
    ``LEAST_DISCOUNT``, or a context whose counts are all large would leave nothing to the unseen."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 > 0 else 0.5
    d = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d.append(min(max(k - (k + 1) * y * b / a, LEAST_DISCOUNT), float(k)) if a > 0 else min(0.75 * k, float(k)))
    return np.array(d)


class Order:
    """The counts of one order, with the total of each context and what the discounts take off it."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, d: np.ndarray):
        self.codes, self.n, self.d = codes, n, d
        self.contexts, first = np.unique(codes >> BITS, return_index=True)
        add = lambda x: np.add.reduceat(x, first).astype(np.float64) if len(x) else x
        self.total, self.off = add(n), add(d[np.minimum(n, 3)])

    def interpolated(self, asked: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities: discounted counts over the context's total, and what was taken off spread
        by ``lower``; contexts never seen give ``lower``."""
        if not len(self.codes):
            return lower
        at = np.minimum(np.searchsorted(self.contexts, asked >> BITS), len(self.contexts) - 1)
        known = self.contexts[at] == asked >> BITS
        own = np.minimum(np.searchsorted(self.codes, asked), len(self.codes) - 1)
        count = np.where(self.codes[own] == asked, self.n[own], 0)
        p = (count - self.d[np.minimum(count, 3)] + self.off[at] * lower) / self.total[at]
        return np.where(known, p, lower)


class Low:
    """Order one, small enough to be sent along, and the discounts of all orders."""

    def __init__(self, before: dict[int, int], seen: np.ndarray):
        one = np.zeros(CLASSES, dtype=np.int64)
        for symbol, n in before.items():
            one[symbol] = n
        self.discounts = [discounts(seen[i:i + 4]) for i in (0, 4, 8)]
        d = discounts(np.array([(one == k).sum() for k in range(1, 5)]))
        uniform = np.full(CLASSES, 1.0 / CLASSES)
        self.one = Order(np.flatnonzero(one), one[one > 0], d).interpolated(np.arange(CLASSES), uniform)

    def orders(self, codes: np.ndarray, n: np.ndarray) -> list[Order]:
        """Orders two to four of the counts of a shard."""
        out = [Order(codes, n, self.discounts[0])]
        for k in (1, 2):
            codes, n = shorter(codes, ORDER + 1 - k)
            out.append(Order(codes, n, self.discounts[k]))
        return out[::-1]

    def probabilities(self, orders: list[Order], asked: np.ndarray) -> np.ndarray:
        """Of codes of order four, by the orders of their shard."""
        p = self.one[asked & (CLASSES - 1)]
        for k, order in enumerate(orders, 2):
            p = order.interpolated(asked & ((1 << (BITS * k)) - 1), p)
        return p


def fitted(written: DataFrame, ids: DataFrame) -> tuple[DataFrame, Low] | None:
    """The shards' counts and the short orders, from the documents of ``ids`` in the written
    blocks; None without trusted text."""
    texts = written.filter("kind = 'text'")
    size = texts.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("docs")).first()
    counts = added_up(ngram_counts(marked(texts, ids, size["docs"])), size["blocks"])
    shards = settled(model_shards(counts), "ngram-shards")
    symbol = shards.select(F.explode(F.arrays_zip("last", "before")).alias("p")).groupBy("p.last").agg(F.sum("p.before").alias("n"))
    before = {r["last"]: r["n"] for r in symbol.collect()}  # at most 65,536 rows
    if not before:
        return None
    seen = shards.agg(*[F.sum(F.col("seen")[i]).alias(f"s{i}") for i in range(12)]).first()
    return shards.select("shard", "codes", "counts"), Low(before, np.array(list(seen)))


def fit(docs: DataFrame, labels: DataFrame, most: int | None = None) -> tuple[DataFrame, Low] | None:
    """The model of all documents labelled good and not toxic, or of ``most`` ids if asked for."""
    return fitted(written_blocks(docs), fewest(good(labels), most))


def fewest(ids: DataFrame, most: int | None) -> DataFrame:
    """All ids, or ``most`` of them, smallest hash first."""
    return ids if most is None else ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of two kinds: ``text`` with the compressed characters and the documents of a block,
    and ``ask`` with the distinct codes of a block that belong to one shard."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, langs, lengths, texts, size = [], [], [], [], 0

        def emit():
            block = (part << 32) + seq
            joined = "".join(texts)
            codes, _ = coded(units(joined))
            data = joined.encode("utf-8", "surrogatepass")
            small = pa.Codec("zstd", compression_level=PACK_LEVEL).compress(data, asbytes=True)
            rows = [("text", block, -1, small, len(data), ids, langs, lengths)]
            rows += [("ask", block, s, packed(codes[at]), len(at), None, None, None) for s, at in by_shard(codes)]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()))
            names = ("kind", "block", "shard", "data", "size", "ids", "langs", "lengths")
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=list(names))

        for batch in batches:
            for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids.append(doc_id)
                langs.append(lang)
                lengths.append(len(text))
                texts.append(escaped(text))
                size += len(texts[-1])
                if size >= block_chars:
                    yield emit()
                    seq += 1
                    ids, langs, lengths, texts, size = [], [], [], [], 0
        if texts:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.lower(text_of()).alias("text"))
    return rows.mapInArrow(
        cut, "kind string, block bigint, shard int, data binary, size bigint, ids array<bigint>, langs array<string>, lengths array<bigint>"
    )


def written_blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The blocks in the shared folder, as the fit and the losses read them."""
    path = scratch_path(docs.sparkSession, "blocks")
    blocks(docs, block_chars).write.partitionBy("kind").option("compression", "uncompressed").parquet(path)
    schema = "block bigint, shard int, data binary, size bigint, ids array<bigint>, langs array<string>, lengths array<bigint>, kind string"
    return docs.sparkSession.read.schema(schema).parquet(path)


def characters(data: bytes, size: int) -> np.ndarray:
    """The symbols of a block, with the edges."""
    return units(str(pa.decompress(data, decompressed_size=size, codec="zstd"), "utf-8", "surrogatepass"))


def answers(asked: DataFrame, shards: DataFrame, low: Low) -> DataFrame:
    """``block, shard, logs``: log-probabilities of the codes each block asked of each shard."""
    n = asked.select("block").distinct().count()
    lanes = max(1, math.ceil(n / BLOCKS_AT_ONCE))
    left = asked.select("shard", F.pmod(F.xxhash64("block"), F.lit(lanes)).alias("lane"), "block", "data", "size")
    right = shards.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))

    def answer(key, asks, model):
        orders = low.orders(*merged(model.column("codes").to_pylist(), model.column("counts").to_pylist()))
        logs = []
        for data, n in zip(asks.column("data"), asks.column("size")):
            wanted = unpacked(data.as_py(), n.as_py())
            logs.append(np.log(low.probabilities(orders, wanted)).astype(np.float32).tobytes())
        return pa.table({"block": asks.column("block"), "shard": asks.column("shard"), "logs": pa.array(logs, pa.binary())})

    return left.groupBy("shard", "lane").cogroup(right.groupBy("shard", "lane")).applyInArrow(answer, "block bigint, shard int, logs binary")


def losses(docs: DataFrame, shards: DataFrame, low: Low, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, lang, n_chars, loss``: summed negative log-probability of each document."""
    return block_losses(written_blocks(docs, block_chars), shards, low)


def block_losses(written: DataFrame, shards: DataFrame, low: Low) -> DataFrame:
    """As :func:`losses`, of written blocks."""
    texts = written.filter("kind = 'text'").select("block", "data", "size", "ids", "langs", "lengths")
    found = answers(written.filter("kind = 'ask'").select("block", "shard", "data", "size"), shards, low)

    def add_up(key, text, logs):
        row = {c: text.column(c)[0].as_py() for c in text.column_names}
        block = characters(row["data"], row["size"])
        codes, at = coded(block)
        of, found = np.empty(len(codes), dtype=np.float32), dict(zip(logs.column("shard").to_pylist(), logs.column("logs")))
        for s, those in by_shard(codes):
            of[those] = np.frombuffer(found[s].as_py(), dtype=np.float32)
        sizes = text_sizes(block)
        ends = np.cumsum(sizes)
        upto = np.concatenate([[0.0], np.cumsum(of[at], dtype=np.float64)])
        loss = -(upto[ends] - upto[ends - sizes])
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "lang": pa.array(row["langs"], pa.string()),
            "n_chars": pa.array(row["lengths"], pa.int64()), "loss": pa.array(loss),
        })

    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        add_up, "doc_id bigint, lang string, n_chars bigint, loss double"
    )


def held_out() -> Column:
    """Whether an id is kept from the fit."""
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0


def fences(scored: DataFrame, fence: float = FENCE) -> DataFrame:
    """``_lang, n, q1, q2, q3, fence``, in thousandths of a nat: exact quartiles of the whole
    numbers ``milli`` by counts per language and value."""
    n = scored.filter(F.col("milli").isNotNull()).groupBy("lang", "milli").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("milli"))
    n = n.withColumn("upto", upto).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("milli")))
    out = n.groupBy("lang").agg(F.max("all").alias("n"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    upper = F.col("q3") + fence * (F.col("q3") - F.col("q1"))
    return out.select(F.col("lang").alias("_lang"), "n", "q1", "q2", "q3", upper.alias("fence"))


def trusted_fences(scored: DataFrame, held: DataFrame, fence: float = FENCE) -> DataFrame:
    """``_lang, fence`` of each language: from the documents whose ids are ``held``, or where
    these are few from the lower half of its distinct documents (by length and loss)."""
    own = fences(scored.join(held, "doc_id", "left_semi"), fence).filter(F.col("n") >= LEAST_HELD)
    own = own.select(F.col("_lang").alias("_own"), F.col("fence").alias("_fence"))
    half = fences(scored.select("lang", "milli", "n_chars").distinct())
    lower = F.col("q2") + (1 + 2 * fence) * (F.col("q2") - F.col("q1"))
    out = half.join(own, F.col("_lang").eqNullSafe(F.col("_own")), "left")
    return out.select("_lang", F.coalesce("_fence", lower).alias("fence"))


def classify(docs: DataFrame, labels: DataFrame, fence: float = FENCE, most: int | None = None,
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, lang, n_chars, perplexity, threshold, kept`` of each document; the model is of all
    trusted documents not held out, or of ``most`` of them if asked for."""
    ids = good(labels)
    out = held_out() & F.lit(ids.count() >= HELD_OUT * LEAST_HELD)
    held = ids.filter(out)
    written = written_blocks(docs, block_chars)
    model = fitted(written, fewest(ids.filter(~out), most))
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
            F.length(text_of()).cast("long").alias("n_chars"), none.alias("perplexity"), none.alias("threshold"),
            (F.length(text_of()) > 0).alias("kept"),
        )
    scored = settled(block_losses(written, *model), "losses")
    scored = scored.withColumn("milli", F.when(F.col("n_chars") > 0, F.round(MILLI * F.col("loss") / F.col("n_chars")).cast("long")))
    out = scored.join(trusted_fences(scored, held, fence), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    most = F.col("fence") + F.when(F.col("n_chars") > 0, MILLI * SHORT / F.sqrt("n_chars"))
    return out.select(
        "doc_id", "lang", "n_chars", F.exp(F.col("milli") / MILLI).alias("perplexity"),
        F.exp(most / MILLI).alias("threshold"), F.coalesce(F.col("milli") <= most, F.lit(False)).alias("kept"),
    )
