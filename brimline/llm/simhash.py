"""Near copies by SimHash fingerprints and multi-index hashing.

A text's fingerprint has the bits set in more than half of its shingles' hashes. Documents
with one fingerprint are one class from then on. Two fingerprints that differ in at most three
bits differ in at most one bit in one of their two halves, so each is entered in a table under
either half, and looks up the halves at one bit's distance (of a pair that differs in a bit,
the one that has it looks up the other). Members of one entry are compared in full and only a
spanning set of links leaves it, never all pairs. An entry with more than ``ENTRY_LIMIT``
members is split by the same rule on the rest of the bits, halves of 16 and then of 8, after
which at most a fixed number of fingerprints can share an entry; the counts that decide this
are combined before the shuffle. Links are joined to components by alternating star steps, in
tables of the shared folder.

Nulls: a NULL text has no words and the fingerprint zero, as has an empty one; NULL ids keep
their row and give no name to a component. Repeated rows are each returned. Tables may be empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brimline.llm.common import fresh, settled, text_of

SHINGLE = 3
SEED = 42
MAX_BITS = 3
ENTRY_LIMIT = 2048
#: Widths of the segments at each level; a segment may differ in this many bits.
LEVELS = (32, 16, 8)
SEGMENT_BITS = MAX_BITS // 2


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[k:k + n] if n > 1 else words[k:k + 1] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    set_bits = np.zeros(64, dtype=np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8", count=n)
    for a in range(0, n, 100_000):
        some = np.unpackbits(hashes[a:a + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += np.add.reduce(some, axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` of each document, the fingerprint as a signed number."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("t"))
    return rows.mapInArrow(each, "doc_id bigint, text_hash bigint, fp bigint")


def entered(rows: DataFrame, width: int) -> DataFrame:
    """Table entries and look-ups on the next segments: ``key, rest, fp, looks``.

    ``rest`` holds the bits not yet used, ``2 * width`` of them; either half becomes part of
    the key and the other the new rest.
    """
    mask = (1 << width) - 1
    low = F.col("rest").bitwiseAND(F.lit(mask))
    high = F.shiftrightunsigned("rest", width).bitwiseAND(F.lit(mask))
    sides = F.array(
        F.struct(F.lit(0).cast("long").alias("side"), low.alias("v"), high.alias("rest")),
        F.struct(F.lit(1).cast("long").alias("side"), high.alias("v"), low.alias("rest")),
    )
    rows = rows.select("key", "fp", F.explode(sides).alias("s"))
    v = F.col("s.v")
    bits = [F.lit(1 << b).cast("long") for b in range(width)]
    near = F.filter(F.array(*bits), lambda b: v.bitwiseAND(b) != 0)
    ball = F.concat(
        F.array(F.struct(v.alias("v"), F.lit(False).alias("looks"))),
        F.transform(near, lambda b: F.struct((v - b).alias("v"), F.lit(True).alias("looks"))),
    )
    rows = rows.select("key", "fp", F.col("s.side").alias("side"), F.col("s.rest").alias("rest"), F.explode(ball).alias("e"))
    key = F.shiftleft("key", width + 1) + F.shiftleft("side", width) + F.col("e.v")
    return rows.select(key.alias("key"), "rest", "fp", F.col("e.looks").alias("looks"))


def joined(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of some fingerprints the smallest position it is linked with, by steps."""
    label = np.full(len(fps), -1)
    for i in range(len(fps)):
        if label[i] >= 0:
            continue
        label[i] = i
        todo = [i]
        while todo:
            open_ = np.flatnonzero(label < 0)
            if not len(open_):
                break
            hit = open_[np.bitwise_count(fps[open_] ^ fps[todo.pop()]) <= max_bits]
            label[hit] = i
            todo.extend(hit.tolist())
    return label


def links(rows: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: for each entry a set of links that joins what is linked in it."""

    def of_entry(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fps = np.unique(fps)
        label = joined(fps, max_bits)
        other = np.flatnonzero(label != np.arange(len(fps)))
        return fps[other], fps[label[other]]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)]
        ended = False
        batches = iter(batches)
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if not ended:
                new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)]
                held = [np.concatenate(p) for p in zip(held, new)]
            keys, fps, looks = held
            # the last entry may go on in the next batch
            whole = len(keys) if ended else int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            held = [c[whole:] for c in held]
            keys, fps, looks = keys[:whole], fps[:whole], looks[:whole]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if whole else np.empty(0, np.int64)
            sizes = np.diff(np.r_[starts, whole])
            tables = np.add.reduceat(~looks, starts) if whole else starts
            pairs = starts[(sizes == 2) & (tables > 0)]
            near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= max_bits
            a, b = [fps[pairs[near]]], [fps[pairs[near] + 1]]
            for i in np.flatnonzero((sizes > 2) & (tables > 0)):
                found = of_entry(fps[starts[i]:starts[i] + sizes[i]])
                a.append(found[0])
                b.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    dealt = rows.select("key", "fp", "looks").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(each, "a bigint, b bigint").filter("a != b")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def all_links(fps: DataFrame, max_bits: int = MAX_BITS, entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """Links that join all fingerprints (``fp``, distinct) within ``max_bits`` of each other.

    Two halves and one bit's look-ups find every pair of at most three bits.
    """
    if max_bits // 2 > SEGMENT_BITS:
        raise ValueError(f"two segments with {SEGMENT_BITS} bit each find at most {MAX_BITS} bits")
    rows = fps.select(F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"), "fp")
    found = []
    for level, width in enumerate(LEVELS):
        rows = entered(rows, width)
        if level + 1 == len(LEVELS):
            found.append(links(rows, max_bits))
            break
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > entry_limit)
        full = settled(counts.select("key"), f"full-entries-{level}")
        if full.isEmpty():
            found.append(links(rows, max_bits))
            break
        found.append(links(rows.join(full, "key", "left_anti"), max_bits))
        rows = rows.join(full, "key", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link, the root being the smallest node reachable.

    Large-star and small-star steps until nothing changes; each reads the table the last one
    wrote. Minima are combined before the shuffle, so a node with very many links is no task.
    """
    edges = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        size = edges.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")
        ).first()
        if size == before or size["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = size
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settled(large.filter("a != b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b")))
        edges = settled(small.distinct(), "small-star")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                entry_limit: int = ENTRY_LIMIT) -> DataFrame:
    """Each document with ``doc_id, text_hash, fp, root`` (smallest linked fingerprint) and
    ``component_id`` (smallest id of its component)."""
    prints = settled(fingerprints(docs, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(all_links(classes.select("fp"), max_bits, entry_limit))
    classes = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(names, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).drop("_fp")


def hexadecimal(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id
    (of equal ids that with the smallest text hash) stays, once if it is repeated."""
    found = near_copies(docs, shingle, max_bits)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k"))
    own, hashed, of_row = (fresh(docs, c) for c in ("_keep_id", "_keep_hash", "_text_hash"))
    keep = best.select(F.col("k.doc_id").alias(own), F.col("k.text_hash").alias(hashed))
    out = docs.withColumn(of_row, F.xxhash64(text_of())).join(
        keep, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(of_row) == F.col(hashed)), "left_semi"
    )
    return out.dropDuplicates(["doc_id", of_row]).select(*[F.col(f"`{c}`") for c in docs.columns])
