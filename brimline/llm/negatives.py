"""Hard negatives by windows of scores, found with a GNAT-style multiway hyperplane tree.

For an anchor, the nearest other rows of its label are its positives; its hard negatives for a
positive are the best rows of other labels whose score lies within two shares of the positive's.
A score window is an annulus around the anchor: with the lengths of a block of vectors known to
lie in a range, the inner product bounds the Euclidean distance from both sides.

The tree is fitted on a bounded sample (``SAMPLE`` vectors, fewer when they are wide) and then
holds every row. Each node has up to ``FANOUT`` split points; a vector goes to the nearest one.
Under each split point lie the ranges of distance from all its siblings to its subtree; a subtree
goes where, by one of these ranges, no distance to the anchor can meet the annulus. Leaves are
sorted by the distance to their split point and cut into blocks, which hold such ranges of their
own. Anchors and blocks meet by number first; only blocks that are left get the vectors of their
anchors, and there every product is worked out exactly. The sample also gives each search a first
bound below, as it holds some of the answers already.

Rows that agree in label and vector are one class with its smallest ids, so a vector that many
rows share is searched and asked once. Ties go to smaller ids. Rows with a NULL id, label or
vector, with a NULL or non-finite component, or one that ``SCALE`` makes infinite take no part;
missing trailing components count as zero, and an empty vector scores zero. Rows that agree in
id, label and vector count once; rows that agree in the id alone are different rows. Scores that
do not fit a long are held at its ends. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import settled

SCALE = 256
#: Bound of the sample the tree is fitted on: so many vectors, and so many bytes of them.
SAMPLE = 4096
SAMPLE_BYTES = 32 << 20
FANOUT = 16
#: A node is split while it has more sample vectors than this, up to ``DEPTH`` times.
LEAF_SAMPLE = 32
DEPTH = 3
BLOCK = 512
ANCHORS_AT_ONCE = 128

POSITIVES = 5
NEGATIVES = 10
#: Shares of the positive's score, in hundredths, between which a negative's lies.
LOWEST, HIGHEST = 30, 90

EXACT = float(1 << 53)
LONG = (1 << 63) - 1
SLACK = 1e-9
FAR = 1e300


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as whole doubles; NULL if one is NULL or not finite."""
    y = F.transform(vector, lambda c: c.cast("double") * scale)
    good = F.forall(y, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # doubles from 2^52 on are whole
    whole = F.transform(y, lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c))
    return F.when(F.coalesce(good, F.lit(False)), whole)


def taken(embeddings: DataFrame, label: Column, key: str, vector: str) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part."""
    rows = embeddings.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled(F.col(f"`{vector}`")).alias("v")
    )
    return rows.dropna(subset=["vec_id", "label", "v"])


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """``cid, label, v, ids``: rows that agree in label and vector, with their ``keep`` smallest ids."""
    order = Window.partitionBy("label", "v").orderBy("vec_id")
    some = rows.withColumn("_nth", F.dense_rank().over(order)).filter(F.col("_nth") <= keep)
    out = some.groupBy("label", "v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    return settled(out.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows padded with zeros to the widest, or to ``width``."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, width, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; by floating point where that is exact."""
    w = min(q.shape[1], p.shape[1])
    q, p = q[:, :w], p[:, :w]
    if float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * w < EXACT:
        return (q @ p.T).astype(np.int64)
    whole = [np.array([int(x) for x in m.ravel()], dtype=object).reshape(m.shape) for m in (q, p)]
    return np.clip(whole[0] @ whole[1].T, -LONG, LONG).astype(np.int64)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows by pivots; infinite ones become ``FAR``."""
    w = max(x.shape[1], pivots.shape[1])
    x, pivots = (np.pad(m, ((0, 0), (0, w - m.shape[1]))) for m in (x, pivots))
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
    return np.nan_to_num(out, nan=FAR, posinf=FAR)


def lengths(m: np.ndarray) -> np.ndarray:
    return distances(m, np.zeros((1, 1)))[:, 0]


class Node:
    """Split points and, under each, another node or the number of a leaf."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.size = lengths(pivots)
        self.under: list[Node | int] = []
        # from split point i to the subtree under j, and the lengths of the vectors under j
        self.low = np.full((len(pivots), len(pivots)), np.inf)
        self.high = np.full((len(pivots), len(pivots)), -np.inf)
        self.short, self.long = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)


def split_points(m: np.ndarray, fanout: int) -> np.ndarray:
    """Rows far from each other, the first far from the middle."""
    chosen = [int(distances(m, m.mean(axis=0, keepdims=True)).argmax())]
    near = distances(m, m[chosen])[:, 0]
    while len(chosen) < fanout and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(m, m[chosen[-1:]])[:, 0])
    return m[chosen]


class Tree:
    """The fitted tree. ``paths[leaf]`` lists the nodes above a leaf and the split point taken in each."""

    def __init__(self, sample: np.ndarray):
        self.paths: list[list[tuple[Node, int]]] = []
        self.root = self.grown(sample, []) if len(sample) else None

    def grown(self, m: np.ndarray, path: list[tuple[Node, int]]) -> Node:
        node = Node(split_points(m, FANOUT))
        nearest = distances(m, node.pivots).argmin(axis=1)
        for j in range(len(node.pivots)):
            inside, here = m[nearest == j], [*path, (node, j)]
            if len(inside) > LEAF_SAMPLE and len(here) < DEPTH and len(node.pivots) > 1:
                node.under.append(self.grown(inside, here))
            else:
                node.under.append(len(self.paths))
                self.paths.append(here)
        return node

    def beside(self, leaf: int) -> Node:
        """The node whose split points stand beside a leaf's own."""
        return self.paths[leaf][-1][0]

    def points(self, leaf: int) -> np.ndarray:
        """The split points of all nodes on the way to a leaf."""
        return np.concatenate([node.pivots for node, _ in self.paths[leaf]])

    def leaves(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each row, and its distance to the split point above the leaf."""
        leaf, far = np.zeros(len(m), dtype=np.int32), np.zeros(len(m))
        todo: list[tuple[Node, np.ndarray]] = [(self.root, np.arange(len(m)))]
        while todo:
            node, at = todo.pop()
            d = distances(m[at], node.pivots)
            nearest = d.argmin(axis=1)
            for j, below in enumerate(node.under):
                inside = nearest == j
                if isinstance(below, Node):
                    if inside.any():
                        todo.append((below, at[inside]))
                else:
                    leaf[at[inside]], far[at[inside]] = below, d[inside, j]
        return leaf, far

    def learn(self, leaf: int, low: list[float], high: list[float], short: float, long: float) -> None:
        """Takes up the ranges of a leaf's vectors into the nodes above it."""
        a = 0
        for node, j in self.paths[leaf]:
            b = a + len(node.pivots)
            node.low[:, j] = np.minimum(node.low[:, j], low[a:b])
            node.high[:, j] = np.maximum(node.high[:, j], high[a:b])
            node.short[j], node.long[j] = min(node.short[j], short), max(node.long[j], long)
            a = b

    def meeting(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Leaf, rows of ``q`` whose annulus may meet it, and their distances to the points beside it."""
        size = lengths(q)
        todo = [(self.root, np.arange(len(q)))] if self.root else []
        while todo:
            node, at = todo.pop()
            d = distances(q[at], node.pivots)
            slack = SLACK * (size[at, None] + node.size)
            for j, below in enumerate(node.under):
                if node.high[0, j] < 0:  # no vector lies there
                    continue
                inner, outer = annulus(size[at], low[at], high[at], node.short[j], node.long[j])
                nearest = np.maximum(node.low[:, j] - d, d - node.high[:, j]) - slack
                farthest = d + node.high[:, j] + slack
                left = ~((nearest.max(axis=1) > outer) | (farthest.min(axis=1) < inner))
                if left.any():
                    if isinstance(below, Node):
                        todo.append((below, at[left]))
                    else:
                        yield below, at[left], d[left]


def annulus(size: np.ndarray, low: np.ndarray, high: np.ndarray, short: float, long: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances between which a vector of length short..long lies whose score is low..high."""
    with np.errstate(over="ignore", invalid="ignore"):
        room = SLACK * (size ** 2 + long ** 2)
        inner = np.sqrt(np.maximum(0, size ** 2 + short ** 2 - 2.0 * high.astype(float) - room))
        outer = np.sqrt(np.maximum(0, size ** 2 + long ** 2 - 2.0 * low.astype(float) + room))
    return inner, outer


class Index(NamedTuple):
    """A tree with all classes in blocks, and the sample that bounds searches from below."""

    tree: Tree
    sample: np.ndarray
    sample_labels: np.ndarray
    blocks: DataFrame


BLOCK_DDL = (
    "leaf int, n int, width int, beside int, low array<double>, high array<double>, short double, long double, "
    "cids binary, firsts binary, labels binary, parts binary"
)


def built(rows: DataFrame) -> Index:
    """Fits the tree on a sample of classes and puts every class into a block of its leaf."""
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    n = max(FANOUT, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    some = rows.orderBy(F.xxhash64("cid"), "cid").limit(n).select("label", "v").toArrow().combine_chunks()
    lists = some["v"].chunk(0) if some.num_rows else pa.array([], pa.list_(pa.float64()))
    sample = matrix(lists, width)
    tree = Tree(sample)
    if not some.num_rows:
        return Index(tree, sample, np.empty(0, dtype=np.int64), spark.createDataFrame([], f"{BLOCK_DDL}, block bigint"))
    shared = spark.sparkContext.broadcast(tree)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf, far = shared.value.leaves(matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(far)], names=[*batch.schema.names, "leaf", "far"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of rows in order, each of one leaf."""
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            edges = np.flatnonzero(np.diff(leaf)) + 1
            starts = [s for a, b in zip([0, *edges], [*edges, len(leaf)]) for s in range(a, b, BLOCK)]
            out: list[tuple] = []
            for a, b in zip(starts, [*starts[1:], len(leaf)]):
                part = batch.slice(a, b - a)
                m, where = matrix(part.column("v")), int(leaf[a])
                points = shared.value.points(where)
                d, size = distances(m, points), lengths(m)
                slack = SLACK * (size.max() + lengths(points))
                columns = [part.column(c).to_numpy().tobytes() for c in ("cid", "first", "label")]
                out.append((where, len(m), m.shape[1], len(shared.value.beside(where).pivots), np.maximum(0, d.min(axis=0) - slack).tolist(), (d.max(axis=0) + slack).tolist(),
                            float(size.min() * (1 - SLACK)), float(size.max() * (1 + SLACK)), *columns, m.tobytes()))
            many = pa.list_(pa.float64())
            kinds = [pa.int32()] * 4 + [many] * 2 + [pa.float64()] * 2 + [pa.binary()] * 4
            names = [c.split()[0] for c in BLOCK_DDL.split(", ")]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    own = rows.select("cid", F.col("ids")[0].alias("first"), "label", "v")
    at = settled(own.mapInArrow(placed, "cid bigint, first bigint, label bigint, v array<double>, leaf int, far double"), "vector-leaves")
    by = at.repartitionByRange("leaf", "far", F.xxhash64("cid")).sortWithinPartitions("leaf", "far", "cid")
    blocks = settled(by.mapInArrow(cut, BLOCK_DDL).withColumn("block", F.monotonically_increasing_id()), "vector-blocks")

    # one row per leaf and split point beside its way: bounded by the sample
    ranges = (
        blocks.select("leaf", "short", "long", F.posexplode(F.arrays_zip("low", "high")).alias("i", "r"))
        .groupBy("leaf", "i").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"), F.min("short").alias("short"), F.max("long").alias("long"))
        .groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("i", "low", "high"))).alias("r"), F.min("short").alias("short"), F.max("long").alias("long"))
    )
    for r in ranges.collect():
        tree.learn(r["leaf"], [x["low"] for x in r["r"]], [x["high"] for x in r["r"]], r["short"], r["long"])
    return Index(tree, sample, some["label"].to_numpy(), blocks)


def best(scores: np.ndarray, firsts: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return at[np.lexsort((firsts[at], -scores[at].astype(float), -scores[at]))[:k]]
    return np.lexsort((firsts, -scores))[:k]


QUERY_DDL = "qid bigint, label bigint, v array<double>, low bigint, high bigint"


def left_blocks(index: Index, queries: DataFrame, same_label: bool, k: int) -> DataFrame:
    """``block, qid, floor``: the blocks that may hold one of the k best rows of a query's window."""
    shared = queries.sparkSession.sparkContext.broadcast((index.tree, index.sample, index.sample_labels))

    def routed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sample, labels = shared.value
        for all_of in batches:
            for a in range(0, all_of.num_rows, ANCHORS_AT_ONCE):
                batch = all_of.slice(a, ANCHORS_AT_ONCE)
                q = matrix(batch.column("v"))
                own, low, high = (batch.column(c).to_numpy() for c in ("label", "low", "high"))
                floor = low.copy()
                if len(sample):
                    scores = products(q, sample)
                    fit = ((own[:, None] == labels) == same_label) & (scores >= low[:, None]) & (scores <= high[:, None])
                    for i in np.flatnonzero(fit.sum(axis=1) >= k):
                        found = scores[i][fit[i]]
                        floor[i] = np.partition(found, len(found) - k)[len(found) - k]
                qid, size = batch.column("qid").to_numpy(), lengths(q)
                for leaf, at, d in tree.meeting(q, floor, high):
                    slack = SLACK * (size[at] + tree.beside(leaf).size.max())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), leaf, dtype=np.int32)), pa.array(qid[at]), pa.array(size[at]), pa.array(slack),
                        pa.array(floor[at]), pa.array(high[at]), pa.array(list(d), pa.list_(pa.float64())),
                    ], names=["leaf", "qid", "size", "slack", "floor", "ceiling", "d"])

    ways = queries.mapInArrow(
        routed, "leaf int, qid bigint, size double, slack double, floor bigint, ceiling bigint, d array<double>"
    )
    # Spark takes what Python returns for as small as what Python got, so no side is left to its guess
    beside = index.blocks.withColumns({c: F.slice(c, -F.col("beside"), F.col("beside")) for c in ("low", "high")})
    pairs = ways.hint("merge").join(beside.select("leaf", "block", "low", "high", "short", "long"), "leaf")
    square = F.col("size") * F.col("size")
    room = SLACK * (square + F.col("long") * F.col("long"))
    inner = square + F.col("short") * F.col("short") - 2.0 * F.col("ceiling") - room
    outer = square + F.col("long") * F.col("long") - 2.0 * F.col("floor") + room
    inner, outer = (F.sqrt(F.greatest(x, F.lit(0.0))) for x in (inner, outer))
    near = F.array_max(F.concat(F.zip_with("low", "d", lambda r, d: r - d), F.zip_with("d", "high", lambda d, r: d - r))) - F.col("slack")
    far = F.array_min(F.zip_with("d", "high", lambda d, r: d + r)) + F.col("slack")
    return pairs.filter(~((near > outer) | (far < inner))).select("block", "qid", "floor")


def searched(index: Index, queries: DataFrame, same_label: bool, k: int) -> DataFrame:
    """``qid, cid, score``: the k best classes of each query's window, by score, then smallest id.

    ``queries`` has the columns of ``QUERY_DDL``; the classes searched are those of the same
    label or those of all others.
    """
    bundles = -(-max(1, queries.count()) // ANCHORS_AT_ONCE)
    pairs = left_blocks(index, queries, same_label, k)
    asked = pairs.hint("merge").join(queries.select("qid", "label", "v", "high"), "qid")
    part = F.pmod(F.xxhash64("qid"), F.lit(bundles))
    bundled = asked.groupBy("block", part.alias("part")).agg(F.collect_list(F.struct("qid", "label", "floor", "high", "v")).alias("asked"))
    payload = index.blocks.select("block", "width", "cids", "firsts", "labels", "parts")

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = {c: batch.column(c)[r].as_py() for c in ("width", "cids", "firsts", "labels", "parts")}
                cids, firsts, labels = (np.frombuffer(block[c], dtype=np.int64) for c in ("cids", "firsts", "labels"))
                m = np.frombuffer(block["parts"], dtype=np.float64).reshape(-1, block["width"])
                those = batch.column("asked")[r].values
                qid, own, low, high = (those.field(c).to_numpy() for c in ("qid", "label", "floor", "high"))
                scores = products(matrix(those.field("v")), m)
                fit = ((own[:, None] == labels) == same_label) & (scores >= low[:, None]) & (scores <= high[:, None])
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i in np.flatnonzero(fit.any(axis=1)):
                    at = np.flatnonzero(fit[i])
                    at = at[best(scores[i][at], firsts[at], k)]
                    for column, values in zip(out, (np.full(len(at), qid[i]), cids[at], firsts[at], scores[i][at])):
                        column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if c else np.empty(0, dtype=np.int64)) for c in out], names=["qid", "cid", "first", "score"]
                )

    found = bundled.hint("merge").join(payload, "block").mapInArrow(verified, "qid bigint, cid bigint, first bigint, score bigint")
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), "first", "cid")
    return found.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= k).select("qid", "cid", "score")


def rows_of(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``qid, cid, vec_id, score, rank``: the k best rows of the classes found."""
    each = found.hint("merge").join(members.select("cid", "ids"), "cid").select("qid", "cid", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id", "cid")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` and ``label`` are columns of ``embeddings``. For each anchor its ``positives``
    best other rows of the same label; for each of them the ``negatives`` best rows of other
    labels with ``lowest * positive_score <= 100 * score <= highest * positive_score``, where
    ``0 <= lowest <= highest``.
    """
    rows = taken(embeddings, label, key, vector)
    members = classes(rows, max(positives + 1, negatives))
    index = built(members)
    anchors = taken(embeddings.filter(is_anchor), label, key, vector).distinct()
    anchors = settled(anchors.join(members.select("label", "v", "cid"), ["label", "v"]).withColumnRenamed("vec_id", "anchor_id"), "anchors")

    # each class with an anchor is asked once, for one row more, as one may be the anchor itself
    asked = settled(anchors.groupBy("cid").agg(F.first("label").alias("label"), F.first("v").alias("v")), "anchor-classes")
    whole = asked.select(F.col("cid").alias("qid"), "label", "v", F.lit(-LONG).alias("low"), F.lit(LONG).alias("high"))
    near = rows_of(searched(index, whole, True, positives + 1), members, positives + 1)
    near = near.select(F.col("qid").alias("own"), F.struct("rank", "cid", "vec_id", "score").alias("p"))
    near = near.groupBy("own").agg(F.sort_array(F.collect_list("p")).alias("near"))
    others = F.filter("near", lambda p: (p["vec_id"] != F.col("anchor_id")) | (p["cid"] != F.col("cid")))
    pairs = anchors.select("anchor_id", "cid").join(near.hint("merge"), F.col("cid") == F.col("own"))
    pairs = pairs.select("anchor_id", "cid", F.explode(F.slice(others, 1, positives)).alias("p"))
    pairs = settled(pairs.select("anchor_id", "cid", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score")), "positives")

    # equal scores of a class have one window; below zero it is empty
    score = F.col("positive_score").cast("decimal(38,0)")
    windows = pairs.filter("positive_score >= 0").select("cid", "positive_score").distinct()
    windows = windows.join(asked, "cid").select(
        F.monotonically_increasing_id().alias("qid"), "cid", "positive_score", "label", "v",
        F.ceil(score * lowest / 100).cast("long").alias("low"), F.floor(score * highest / 100).cast("long").alias("high"),
    )
    windows = settled(windows, "windows")
    hard = rows_of(searched(index, windows.select("qid", "label", "v", "low", "high"), False, negatives), members, negatives)
    hard = hard.hint("merge").join(windows.select("qid", F.col("cid").alias("_cid"), F.col("positive_score").alias("_score")), "qid")
    hard = hard.select("_cid", "_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = pairs.join(hard.hint("merge"), (F.col("cid") == F.col("_cid")) & (F.col("positive_score") == F.col("_score")))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
