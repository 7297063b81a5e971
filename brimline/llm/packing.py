"""Best-fit packing of token pieces into sequences, after Martello-Toth dominance reduction.

Piece lengths are whole numbers up to the capacity, so the packing instance is a histogram of
at most ``capacity`` numbers, whatever the number of documents. On it, sets that provably
dominate every other set with their largest piece are fixed first (nothing else fits; an
exact pair; one more fits at most; two more fit at most and none beats the best partner), each
as often as its pieces allow; best-fit decreasing places the rest. The result is a bounded
table of runs: pieces of one length with ranks in a range go to consecutive sequences at one
offset. Ranks come from counts per length and bucket, so no length meets in one task.

Nulls: a NULL text is empty and has the separator only. NULL ids keep their piece. Repeated
rows are packed each. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import settled, text_of
from brimline.llm.tokens import ID_BYTES, encoder, vocabulary_path

CAPACITY = 2048
SEPARATOR = 0
#: Texts are encoded in groups of about this many characters.
GROUP_CHARS = 4_000_000


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` characters, at least one text each."""
    a, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= most:
            yield a, i + 1
            a, n = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; the first takes what is over."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``, and ``ids`` (little-endian 32 bits) if asked for."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        schema, names = f"{schema}, ids binary", [*names, "ids"]
    end = np.array([separator], dtype="<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                out: list[list] = [[] for _ in names]
                for doc_id, raw in zip(ids[a:b], known.encode(texts[a:b])):
                    raw += end
                    for k, (s, n) in enumerate(cuts(len(raw) // ID_BYTES, capacity)):
                        part = raw[s * ID_BYTES:(s + n) * ID_BYTES]
                        for col, v in zip(out, (doc_id, k, s, n, zlib.crc32(part), part)):
                            col.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(cut, schema)


class Plan:
    """Runs of equal placements: ``(length, first rank, first sequence, offset, per sequence)``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(capacity + 1, dtype=np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.fixed = 0

    def take(self, length: int, first: int, offset: int, per: int, times: int) -> None:
        """``per`` pieces in each of ``times`` sequences from ``first`` on."""
        self.runs.append((length, int(self.used[length]), first, offset, per))
        self.used[length] += per * times
        self.left[length] -= per * times

    def fix(self, lengths: list[int]) -> None:
        """A set of pieces in sequences of its own, as often as there are pieces."""
        need = Counter(lengths)
        times = int(min(self.left[x] // n for x, n in need.items()))
        offset = 0
        for x, n in sorted(need.items(), reverse=True):
            self.take(x, self.sequences, offset, n, times)
            offset += x * n
        self.sequences += times
        self.fixed += times

    def dominating(self, j: int) -> list[int] | None:
        """A set with one piece of length ``j`` that dominates all others, if one is provable."""
        others = self.left.copy()
        others[j] -= 1
        room = self.capacity - j
        sizes = np.flatnonzero(others[:room + 1])
        if not len(sizes):
            return [j]
        best = int(sizes[-1])
        if best == room:
            return [j, best]
        small = []
        for x in sizes[:3]:
            small += [int(x)] * int(min(others[x], 3 - len(small)))
            if len(small) == 3:
                break
        if len(small) < 2 or small[0] + small[1] > room:
            return [j, best]
        if len(small) == 3 and sum(small) <= room:
            return None
        # at most two more fit: compare the best partner with the best pair
        have = others[:room + 1] > 0
        a, b = 0, 0
        for x in sizes[::-1]:
            x = int(x)
            if 2 * x <= a + b:
                break
            others[x] -= 1
            fits = np.flatnonzero(others[:min(x, room - x) + 1]) if room >= x else ()
            others[x] += 1
            if len(fits) and x + int(fits[-1]) > a + b:
                a, b = x, int(fits[-1])
        if best >= a + b:
            return [j, best]
        if a + b == room and best == a:
            larger = np.flatnonzero(have[b + 1:]) + b + 1
            two = [int(x) for x in larger for _ in range(int(min(others[x], 2)))][:2]
            if len(two) < 2 or sum(two) > room:
                return [j, a, b]
        return None

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for j in range(self.capacity, 0, -1):
                while self.left[j]:
                    found = self.dominating(j)
                    if found is None:
                        break
                    self.fix(found)
                    changed = True

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence with room; sequences alike are one entry."""
        open_: dict[int, list[list[int]]] = defaultdict(list)  # room -> [first sequence, how many]
        for j in range(self.capacity, 0, -1):
            while self.left[j]:
                room = min((r for r in open_ if r >= j and open_[r]), default=None)
                if room is None:
                    room, n = self.capacity, -(-int(self.left[j]) // (self.capacity // j))
                    open_[room].append([self.sequences, n])
                    self.sequences += n
                first, n = open_[room].pop()
                per = room // j
                full = min(n, int(self.left[j]) // per)
                if full:
                    self.take(j, first, self.capacity - room, per, full)
                    open_[room - per * j].append([first, full])
                rest = int(self.left[j])
                if full < n and rest and rest < per:
                    self.take(j, first + full, self.capacity - room, rest, 1)
                    open_[room - rest * j].append([first + full, 1])
                    full += 1
                if full < n:
                    open_[room].append([first + full, n - full])

    def solve(self) -> Plan:
        self.reduce()
        self.best_fit()
        return self

    def tables(self) -> dict[int, tuple[np.ndarray, ...]]:
        by: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for length, *run in self.runs:
            by[length].append(tuple(run))
        return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*sorted(runs))) for length, runs in by.items()}


def ranked(rows: DataFrame, buckets: int) -> DataFrame:
    """``_rank``: a number from 0 for each row among those of its length, in any order."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    counts = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")
    counts = counts.select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    out = rows.withColumn("_inside", inside).join(counts, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
    return out.withColumn("_rank", (F.col("_before") + F.col("_inside")).cast("long")).drop("_l", "_b", "_bucket", "_before", "_inside")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Texts are encoded once; what later steps need of the pieces is written to the shared
    folder. The driver sees one count per length.
    """
    rows = settled(pieces(docs, vocabulary, capacity, separator), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = Plan(counts, capacity).solve().tables()
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = ranked(rows, buckets)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, start, place, per = runs[int(x)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                nth = rank[at] - first[k]
                sequence[at] = start[k] + nth // per[k]
                offset[at] = place[k] + nth % per[k] * x
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"]
            )

    return numbered.mapInArrow(
        placed,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
