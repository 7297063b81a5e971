"""Token ids as raw binary shards with a minimal perfect hash index.

Documents in ascending order of id are encoded and laid end to end. A shard is one row of a
Parquet table (so that Spark's committer writes it to any store, and a lost executor leaves
nothing half done): the ids as raw little-endian numbers, 16 bits wide if the vocabulary
allows, the start of each document in them, and an index from document id to its place. The
index is a hash-and-displace minimal perfect hash: a bucket of keys has one displacement that
sends its keys to free slots, a slot holds a fingerprint and the place, so a key is found by
two hashes and one comparison, and unknown keys are turned away by the fingerprint and key.

Nulls: a NULL text is empty; documents without an id come first and have no index entry.
Repeated ids lie side by side, their entry points to the first. Very long texts are a shard
of their own. An empty table writes an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brimline.llm.common import text_of
from brimline.llm.packing import groups
from brimline.llm.tokens import ID_BYTES, encoder, vocabulary_path

SHARD_BYTES = 4 << 20
PER_BUCKET = 4

SHARD = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
    ("ids_before", pa.int64()), ("first_key", pa.int64()), ("last_key", pa.int64()),
    ("keys", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ("displacements", pa.list_(pa.int64())), ("fingerprints", pa.list_(pa.int64())), ("places", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])
SHARD_DDL = (
    "part int, seq int, width int, n_docs bigint, n_ids bigint, ids_before bigint, first_key bigint, last_key bigint, "
    "keys array<bigint>, starts array<bigint>, displacements array<bigint>, fingerprints array<bigint>, places array<bigint>, payload binary"
)


def mixed(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key under a seed (two xor-shift-multiply rounds)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + (np.asarray(seed).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


BUCKET_SEED, PRINT_SEED, FIRST_TRY = 1, 2, 16


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Displacements, and by slot fingerprints and the keys' positions; keys are distinct.

    Fullest buckets go first. A displacement d >= 0 is a seed that sends the bucket's keys to
    free slots; a bucket of one key takes any free slot s, written as -s - 1.
    """
    n = len(keys)
    buckets = max(1, -(-n // PER_BUCKET))
    of = (mixed(keys, BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    ends = np.cumsum(sizes)
    displacements = np.zeros(buckets, dtype=np.int64)
    places = np.full(n, -1, dtype=np.int64)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[ends[b] - sizes[b]:ends[b]]
        if len(members) < 2:
            break
        seed = FIRST_TRY
        while True:
            tries = np.arange(seed, seed + 64)[:, None]
            slots = (mixed(keys[members][None, :], tries) % np.uint64(n)).astype(np.int64)
            free = (places[slots] < 0).all(axis=1)
            in_order = np.sort(slots, axis=1)
            good = np.flatnonzero(free & (in_order[:, 1:] != in_order[:, :-1]).all(axis=1))
            if len(good):
                displacements[b] = seed + good[0]
                places[slots[good[0]]] = members
                break
            seed += 64
    singles = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(places < 0)
    places[free] = order[ends[singles] - 1]
    displacements[singles] = -free - 1
    fingerprints = (mixed(keys, PRINT_SEED) >> np.uint64(32)).astype(np.int64)[places] if n else places
    return displacements, fingerprints, places


def find(key: int, n: int, displacements, fingerprints, places) -> int | None:
    """The position of a key among those indexed, or None by its fingerprint."""
    if not n:
        return None
    one = np.array([key], dtype=np.int64)
    d = int(displacements[int(mixed(one, BUCKET_SEED)[0] % np.uint64(len(displacements)))])
    slot = -d - 1 if d < 0 else int(mixed(one, d)[0] % np.uint64(n))
    print_ = int(mixed(one, PRINT_SEED)[0] >> np.uint64(32))
    return int(places[slot]) if fingerprints[slot] == print_ else None


def find_all(keys: np.ndarray, displacements: np.ndarray, fingerprints: np.ndarray, places: np.ndarray) -> np.ndarray:
    """As :func:`find` for many keys at once; a key that the index does not hold is an error."""
    if not len(keys):
        return np.empty(0, dtype=np.int64)
    n = np.uint64(len(places))
    d = displacements[(mixed(keys, BUCKET_SEED) % np.uint64(len(displacements))).astype(np.int64)]
    slot = np.where(d < 0, -d - 1, (mixed(keys, np.maximum(d, 0)) % n).astype(np.int64))
    if (fingerprints[slot] != (mixed(keys, PRINT_SEED) >> np.uint64(32)).astype(np.int64)).any():
        raise ValueError("the index of a shard does not hold one of its keys")
    return places[slot]


def positions_of(row: dict) -> np.ndarray:
    """Where the rows of a shard stand, in order of key: rows without a key come first, those of
    a key from the place that the index gives for it."""
    keys = np.array([k for k in row["keys"] if k is not None], dtype=np.int64)
    index = (np.array(row[c], dtype=np.int64) for c in ("displacements", "fingerprints", "places"))
    distinct, counts = np.unique(keys, return_counts=True)
    first = np.repeat(find_all(distinct, *index), counts)
    nth = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.concatenate([np.arange(len(row["keys"]) - len(keys)), first + nth])
    if not np.array_equal(np.sort(at), np.arange(len(row["keys"]))):
        raise ValueError("the index of a shard points to a place twice")
    return at


def shard_row(part: int, seq: int, width: int, ids_before: int, keys: list, parts: list[bytes]) -> pa.RecordBatch:
    """One shard; ``parts`` are the documents' ids in 32 bits."""
    starts = np.concatenate([[0], np.cumsum([len(p) // ID_BYTES for p in parts])]).astype(np.int64)
    payload = np.frombuffer(b"".join(parts), dtype="<u4").astype(f"<u{width}").tobytes()
    known = np.array([k for k in keys if k is not None], dtype=np.int64)
    distinct, first = np.unique(known, return_index=True)
    displacements, fingerprints, places = build_index(distinct)
    places = first[places] + (len(keys) - len(known)) if len(distinct) else places
    row = (
        part, seq, width, len(parts), int(starts[-1]), ids_before, int(known[0]) if len(known) else None,
        int(known[-1]) if len(known) else None, keys, starts, displacements, fingerprints, places, payload,
    )
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, SHARD.types)], schema=SHARD)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Encodes every text, appends ``end_id``, and writes the store.

    Documents are dealt by ranges of id; equal ids are parted by their text and place, so one
    id with many rows does not meet in one task.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary_path(vocabulary))
        width = 2 if max(len(known.opens), end_id + 1) <= 1 << 16 else 4
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                for key, raw in zip(ids[a:b], known.encode(texts[a:b])):
                    if parts and size + len(raw) > shard_bytes * ID_BYTES // width:
                        yield shard_row(part, seq, width, before, keys, parts)
                        seq, before = seq + 1, before + size // ID_BYTES
                        keys, parts, size = [], [], 0
                    keys.append(key)
                    parts.append(raw + end)
                    size += len(raw) + ID_BYTES
        if parts:
            yield shard_row(part, seq, width, before, keys, parts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text")).withColumn("_i", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("doc_id", "_h", "_i").sortWithinPartitions("doc_id", "_h", "_i")
    dealt.select("doc_id", "text").mapInArrow(shards, SHARD_DDL).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: ``doc_id, start`` (ids before it in the store), ``n_tokens, ids_crc32``,
    and ``ids`` if asked for, all from the files.

    Each document is found by its key: key to slot, fingerprint, place, offset. An index that
    does not lead every key to rows of its own fails the read.
    """
    store = spark.read.schema(SHARD_DDL).parquet(path)
    sizes = store.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    # one row per task that wrote, at most as many as it had partitions
    bases = sizes.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["payload"], dtype=f"<u{row['width']}").astype("<u4")
                at = positions_of(row)
                starts = np.array(row["starts"], dtype=np.int64)
                first, last = starts[:-1][at], starts[1:][at]
                raw = memoryview(ids.tobytes())
                spans = list(zip(first.tolist(), last.tolist()))
                crc = [zlib.crc32(raw[a * ID_BYTES:b * ID_BYTES]) for a, b in spans]
                keys = sorted(row["keys"], key=lambda k: (k is not None, k))
                cols = [pa.array(keys, pa.int64()), pa.array(first + row["ids_before"] + row["base"]),
                        pa.array(last - first), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array([ids[a:b].astype(np.int32) for a, b in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    columns = ["part", "width", "ids_before", "keys", "starts", "displacements", "fingerprints", "places", "payload"]
    rows = store.select(*columns).join(F.broadcast(bases), "part")
    return rows.mapInArrow(documents, schema)


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """The ids of some documents, ``doc_id, ids``, through the index of the shards whose key
    range holds them; all rows of a repeated id are returned."""
    wanted = sorted(set(keys))
    store = spark.read.schema(SHARD_DDL).parquet(path)
    if not wanted:
        return spark.createDataFrame([], "doc_id bigint, ids array<int>")
    near = store.filter((F.col("last_key") >= wanted[0]) & (F.col("first_key") <= wanted[-1]))

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["payload"], dtype=f"<u{row['width']}")
                found: list[tuple[int, np.ndarray]] = []
                for key in wanted:
                    at = find(key, len(row["places"]), row["displacements"], row["fingerprints"], row["places"])
                    while at is not None and at < len(row["keys"]) and row["keys"][at] == key:
                        found.append((key, ids[row["starts"][at]:row["starts"][at + 1]].astype(np.int32)))
                        at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.int64()), pa.array([v for _, v in found], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return near.mapInArrow(fetch, "doc_id bigint, ids array<int>")
