"""Exact top-k by inner product with norm buckets.

Vectors are dealt by length (norm), longest first, and cut into blocks of at most ``BLOCK``
of similar length. The longest ``SEED_VECTORS`` give every query a first k-th score. With that
score a block has a local cosine threshold, the cosine its longest vector would need: above
one the block is passed over; high thresholds prune by coordinates (a vector within the angle
of the query has its largest coordinates within a range), low ones by length (the prefix long
enough). A block and a block of queries are paired only if the longest vector may reach a score.
What is left is verified by exact products of whole numbers. A block hands on at most
k rows per query, and the thresholds rise while a task works through its blocks.

Blocks are dealt to lanes and blocks of queries to groups; a tile of both is a join key, so a
block is copied once per group and a query once per lane (:func:`tiles`). The driver gets the
first blocks, ``SEED_BYTES`` at most, and one row of totals, whatever the size of the table.

Queries come in blocks as well, queries that need alike lengths together.
Nulls: vectors that are NULL or hold a NULL or non-finite component take no part; missing
trailing components count as zero; an empty vector scores zero. Repeated rows each count;
rows of the query's own id, and rows without an id, never do. Ties go to the smaller id. An empty
table gives no rows; other columns are not read. Components of any size are multiplied exactly; a
score that does not fit a long is held at its end.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import settled
from brimline.llm.negatives import products

SCALE = 1024
BLOCK = 512
QUERY_BLOCK = 256
SEED_VECTORS = 1024
#: Bound of what the driver gets of them, in whole blocks (one at least).
SEED_BYTES = 32 << 20
#: Pairs of blocks that are worth a task, and bytes of queries that a tile holds.
PAIRS = 256
GROUP_BYTES = 64 << 20
#: Local cosine threshold from which coordinates prune better than lengths.
COORDINATE_FROM = 0.6
FOCUS = 4
SLACK = 1e-9

BLOCK_DDL = "block bigint, n int, width int, longest double, ids binary, parts binary"


def scaled(embedding: Column) -> Column:
    """floor(1024 x) of each component as a whole double; NULL if one is NULL or not finite."""
    y = F.transform(embedding, lambda c: c.cast("double") * SCALE)
    good = F.forall(y, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # doubles from 2^52 on are whole
    whole = F.transform(y, lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    rows = embeddings.select(F.col(f"`{key}`").cast("long").alias("id"), scaled(F.col(f"`{vector}`")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return rows.filter(F.col("v").isNotNull() & F.col("id").isNotNull()).withColumn("norm", F.sqrt(square))


def matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components, rows padded with zeros to the widest of the batch."""
    lists = batch.column(1)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return batch.column(0).to_numpy(), out


def norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((np.asarray(m, dtype=np.float64) ** 2).sum(axis=1))


def blocked(rows: DataFrame, size: int) -> DataFrame:
    """Rows cut into blocks as they come, each block sorted by falling length."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                ids, m = matrix(batch.slice(a, size))
                length = norms(m)
                order = np.argsort(-length, kind="stable")
                row = (0, len(ids), m.shape[1], float(length.max()), ids[order].tobytes(), m[order].tobytes())
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["block", "n", "width", "longest", "ids", "parts"])

    out = rows.select("id", "v").mapInArrow(cut, BLOCK_DDL)
    return out.withColumn("block", F.monotonically_increasing_id())


def unpack(ids: bytes, parts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(parts, dtype=np.float64).reshape(-1, width)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(ids) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Block:
    """Vectors of similar length, longest first, with unit directions for coordinate pruning."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        self.ids, self.m = ids, m
        self.length = norms(m)
        self.longest = float(self.length[0])
        self.unit = m / np.maximum(self.length, 1e-300)[:, None]

    def left_by_coordinates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors within the angle: at the query's largest coordinates their own lie in a range."""
        angle = np.arccos(min(cosine, 1.0))
        keep = np.ones(len(self.ids), dtype=bool)
        w = min(len(unit), self.unit.shape[1])
        for f in np.argsort(-np.abs(unit[:w]), kind="stable")[:FOCUS]:
            at = np.arccos(np.clip(unit[f], -1.0, 1.0))
            low, high = np.cos(min(np.pi, at + angle)), np.cos(max(0.0, at - angle))
            keep &= (self.unit[:, f] >= low - SLACK) & (self.unit[:, f] <= high + SLACK)
        return np.flatnonzero(keep)

    def left_by_length(self, needed: float) -> int:
        """How many from the front are at least this long."""
        return int(np.searchsorted(-self.length, -needed * (1 - SLACK), side="right"))


def search(queries: tuple[np.ndarray, np.ndarray], floor: np.ndarray, block: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query row the ids and scores of a block that may be among its k best."""
    ids, m = queries
    length = norms(m)
    whole: list[tuple[int, int]] = []
    for i in range(len(ids)):
        need = float(floor[i])
        if need <= 0 or length[i] == 0:
            # no positive threshold: any direction may qualify
            if need <= 0:
                whole.append((i, len(block.ids)))
            continue
        cosine = need * (1 - SLACK) / (length[i] * max(block.longest, 1e-300))
        if cosine > 1:
            continue
        if cosine >= COORDINATE_FROM:
            at = block.left_by_coordinates(m[i] / length[i], cosine)
            if len(at):
                scores = products(m[i:i + 1], block.m[at])[0]
                yield i, block.ids[at], scores
        else:
            n = block.left_by_length(need / length[i])
            if n:
                whole.append((i, n))
    if whole:
        rows = np.array([i for i, _ in whole])
        scores = products(m[rows], block.m[:max(n for _, n in whole)])
        for (i, n), s in zip(whole, scores):
            yield i, block.ids[:n], s[:n]


def least_length(floor: np.ndarray, length: np.ndarray) -> float:
    """The length a vector needs to reach any of the scores; below zero if any vector may."""
    free = floor <= 0
    if free.any() or not len(floor):
        return -1.0
    return float((floor / np.maximum(length, 1e-300)).min())


def longest_vectors(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components of the longest vectors, out of whole blocks: the tasks send numbers of
    blocks, and only those chosen come with their vectors."""
    at, n, size = [], 0, 0
    for r in blocks.select("block", "n", "width", "longest").orderBy(F.col("longest").desc(), "block").limit(SEED_VECTORS).collect():
        size += 8 * r["n"] * r["width"]
        if n >= SEED_VECTORS or at and size > SEED_BYTES:
            break
        at.append(r["block"])
        n += r["n"]
    rows = blocks.filter(F.col("block").isin(at)).select("ids", "parts", "width").collect() if at else []
    found = [unpack(r["ids"], r["parts"], r["width"]) for r in rows]
    ids = np.concatenate([i for i, _ in found] or [np.empty(0, np.int64)])
    m = np.zeros((len(ids), max((p.shape[1] for _, p in found), default=1)))
    a = 0
    for _, p in found:
        m[a:a + len(p), :p.shape[1]] = p
        a += len(p)
    first = np.argsort(-norms(m), kind="stable")[:SEED_VECTORS]
    return ids[first], m[first]


def tiles(blocks: DataFrame, queries: DataFrame) -> tuple[int, int]:
    """Lanes of blocks and groups of query blocks. Their product is the number of tasks; of all such
    products it has the fewest copied bytes, ``groups`` times the blocks and ``lanes`` times the queries."""
    spark = blocks.sparkSession
    size = F.coalesce(F.sum(F.col("n").cast("double") * F.col("width") * 8), F.lit(0.0)).alias("size")
    b, q = (x.agg(F.count(F.lit(1)).alias("n"), size).first() for x in (blocks, queries))
    tasks = max(4 * spark.sparkContext.defaultParallelism, b["n"] * q["n"] // PAIRS)
    tasks = max(1, min(tasks, b["n"] * q["n"], int(spark.conf.get("spark.sql.shuffle.partitions"))))
    groups = max(round(math.sqrt(tasks * q["size"] / max(b["size"], 1.0))), math.ceil(q["size"] / GROUP_BYTES))
    groups = max(1, min(groups, q["n"]))
    return max(1, min(b["n"], math.ceil(tasks / groups))), groups


def top_k(embeddings: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every query over all other rows."""
    spark = embeddings.sparkSession
    rows = vectors(embeddings, key, vector)
    asked = vectors(embeddings.filter(is_query), key, vector)
    dealt = rows.repartitionByRange(F.col("norm").desc(), F.xxhash64("id")).sortWithinPartitions(F.col("norm").desc(), "id")
    blocks = settled(blocked(dealt, BLOCK), "vector-blocks")
    queries = settled(blocked(asked.repartition(F.xxhash64("id")).sortWithinPartitions("norm", "id"), QUERY_BLOCK), "query-blocks")

    # a bounded number of the longest vectors, for a first threshold of every query
    shared = spark.sparkContext.broadcast(longest_vectors(blocks))

    def floors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s_ids, s_m = shared.value
        for batch in batches:
            out, reach = [], []
            for ids, parts, w in zip(batch.column("ids"), batch.column("parts"), batch.column("width")):
                q_ids, m = unpack(ids.as_py(), parts.as_py(), w.as_py())
                found = np.full(len(q_ids), np.iinfo(np.int64).min, dtype=np.int64)
                if len(s_ids):
                    scores = products(m, s_m)
                    for i, q in enumerate(q_ids):
                        own = scores[i][s_ids != q]
                        if len(own) >= k:
                            found[i] = np.partition(own, len(own) - k)[len(own) - k]
                out.append(found.tobytes())
                reach.append(least_length(found, norms(m)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary()), pa.array(reach, pa.float64())], names=[*batch.schema.names, "floors", "reach"]
            )

    q = settled(queries.mapInArrow(floors, f"{BLOCK_DDL}, floors binary, reach double"), "query-floors")
    lanes, groups = tiles(blocks, q)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).withColumn("group", every(groups))
    left = left.select((F.col("lane") * groups + F.col("group")).alias("tile"), "longest", F.col("ids").alias("b_ids"), F.col("parts").alias("b_parts"), F.col("width").alias("b_width"))
    right = q.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")).withColumn("lane", every(lanes))
    right = right.select((F.col("lane") * groups + F.col("group")).alias("asked_tile"), F.col("block").alias("asked"), "ids", "parts", "width", "floors", "reach")
    # the join itself drops pairs whose longest vector reaches no score: Python never sees them
    may = (F.col("tile") == F.col("asked_tile")) & (F.col("longest") * (1 + SLACK) >= F.col("reach"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised: dict[int, np.ndarray] = {}  # thresholds of the query blocks met in this task
        for batch in batches:
            for r in range(batch.num_rows):
                one = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                block = Block(*unpack(one["b_ids"], one["b_parts"], one["b_width"]))
                q_ids, m = unpack(one["ids"], one["parts"], one["width"])
                floor = raised.setdefault(one["asked"], np.frombuffer(one["floors"], dtype=np.int64).copy())
                out = [[], [], []]
                for i, ids, scores in search((q_ids, m), floor, block, k):
                    ok = (ids != q_ids[i]) & (scores >= floor[i])
                    ids, scores = ids[ok], scores[ok]
                    at = best(ids, scores, k)
                    if len(at) == k:
                        floor[i] = max(floor[i], scores[at[-1]])
                    out[0].append(np.full(len(at), q_ids[i]))
                    out[1].append(ids[at])
                    out[2].append(scores[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out], names=["query_id", "vec_id", "score"]
                )

    # Spark takes the copies per lane for as small as one, so no side is left to its guess
    found = left.join(right.hint("merge"), may).mapInArrow(compare, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
