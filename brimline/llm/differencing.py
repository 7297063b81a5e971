"""Packing by Karmarkar-Karp multiway differencing: full windows with few cuts.

Each task packs what it encodes, so that no row is shuffled and no key can be hot. A document
gives its whole windows at once; what is over waits as one piece. Every ``GROUP`` waiting pieces
are differenced: each piece starts as a partial partition of one sum, and the two partial
partitions with the largest spread are merged again and again, the large sums of one with the
small sums of the other, until one partition into windows of nearly equal sums is left. A window
beyond the capacity is cut there and closed; what was cut off makes the number of windows rise,
as it is differenced again with the windows that are still short. So every closed window is
exactly full, at about one cut for each. Fewer ids than a window wait for the next group; the
last of a task are cut into sequences of a power of two, which need no padding.

Nulls: a NULL text is empty and has the separator only; a NULL id keeps its pieces. Repeated
rows and ties are packed each. Long texts never wait whole: under one window of each does. An
empty table gives no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brimline.llm.common import text_of
from brimline.llm.packing import groups
from brimline.llm.tokens import ID_BYTES, encoder, vocabulary_path

CAPACITY = 1024
SEPARATOR = 0
#: Pieces that are differenced together; under one window of ids each.
GROUP = 1024
#: Sequence numbers of a task start at its partition times this.
SEQUENCES_OF_TASK = 1 << 40

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
KINDS = [pa.int64()] * 7
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def differenced(sizes: list[int], k: int) -> list[list[int]]:
    """The positions of ``sizes`` dealt to ``k`` windows of nearly equal sums.

    A partial partition holds its sums, less the smallest of the k, largest first; sums that
    are not there are zero. Each sum names the node of a tree whose leaves are its pieces.
    """
    nodes: list[tuple[int, int] | None] = [None] * len(sizes)
    heap = [(-x, i, [(x, i)]) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        shared = max(0, len(a) + len(b) - k)
        sums = a[:len(a) - shared] + b[:len(b) - shared]
        for (x, p), (y, q) in zip(a[len(a) - shared:], reversed(b[len(b) - shared:])):
            sums.append((x + y, len(nodes)))
            nodes.append((p, q))
        sums.sort(reverse=True)
        least = sums[-1][0] if len(sums) == k else 0
        if least:
            sums = [(x - least, p) for x, p in sums]
        heapq.heappush(heap, (-sums[0][0], made, sums))
        made += 1
    windows = []
    for _, root in heap[0][2] if heap else ():
        leaves, todo = [], [root]
        while todo:
            node = todo.pop()
            if nodes[node] is None:
                leaves.append(node)
            else:
                todo += nodes[node]
        windows.append(leaves)
    return windows


class Piece:
    """A run of a document's ids that is not placed yet."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id: int | None, start: int, ids: bytes, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, n: int) -> tuple[Piece, Piece]:
        at = n * ID_BYTES
        return (Piece(self.doc_id, self.start, self.ids[:at], self.total),
                Piece(self.doc_id, self.start + n, self.ids[at:], self.total))


class Packer:
    """Windows of one task."""

    def __init__(self, first: int, capacity: int = CAPACITY, group: int = GROUP):
        self.next, self.capacity, self.group = first, capacity, group
        self.waiting: list[Piece] = []
        self.held = 0  # ids of the waiting pieces
        self.out: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        """One sequence of these pieces."""
        offset = 0
        for p in pieces:
            self.out.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.total, self.next, offset))
            offset += len(p)
        self.next += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // ID_BYTES
        rest = Piece(doc_id, 0, ids, total)
        while len(rest) >= self.capacity:
            full, rest = rest.cut(self.capacity)
            self.close([full])
        if len(rest):
            self.waiting.append(rest)
            self.held += len(rest)
        if len(self.waiting) >= self.group and self.held >= self.capacity:
            self.fill()

    def fill(self) -> None:
        """Closes as many full windows as the waiting pieces give; under one window stays."""
        pieces = self.waiting
        while (k := sum(map(len, pieces)) // self.capacity) > 0:
            short: list[Piece] = []
            for window in differenced([len(p) for p in pieces], k):
                inside, room = [], self.capacity
                for p in sorted((pieces[i] for i in window), key=len, reverse=True):
                    if len(p) > room > 0:
                        p, over = p.cut(room)
                        short.append(over)
                    (inside if room else short).append(p)
                    room -= len(p) if room else 0
                if room:
                    short += inside
                else:
                    self.close(inside)
            pieces = short
        self.waiting, self.held = pieces, sum(map(len, pieces))

    def finish(self) -> None:
        """The last ids, in sequences of falling powers of two."""
        self.fill()
        rest, left = self.waiting, self.held
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            inside = []
            while room:
                p = rest.pop()
                if len(p) > room:
                    p, over = p.cut(room)
                    rest.append(over)
                inside.append(p)
                room -= len(p)
            self.close(inside)

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = list(zip(*rows)) if rows else [[]] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], names=NAMES)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
         group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``capacity`` must be a power of two, or the last sequences of a task need padding.
    """
    end = np.array([separator], dtype="<u4").tobytes()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary_path(vocabulary))
        packer = Packer(TaskContext.get().partitionId() * SEQUENCES_OF_TASK, capacity, group)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                for doc_id, raw in zip(ids[a:b], known.encode(texts[a:b])):
                    packer.add(doc_id, raw + end)
                yield packer.taken()
        packer.finish()
        yield packer.taken()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(packed, SCHEMA)
