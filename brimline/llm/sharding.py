"""Sharding by extendible hashing: a directory over hash-prefix bits, split only where full.

A document's key is 120 bits: 60 of the MD5 of its id, then 60 of the MD5 of its text. A
bucket is a prefix; one that holds more bytes than the limit is split on the next bit, the
others stay. A round counts bytes per fine prefix in one shuffle, adds them up to all coarser
prefixes, and reads off every split down to that depth at once; only what is still too full
goes into the next round, so the number of rounds follows the depth and not the data. What
120 bits cannot part (equal rows) is cut into overflow pages, so every shard is within the
limit unless it is a single document that is larger.

Nulls: a NULL id or text is hashed as a word of its own and takes no bytes. An empty table
has no shards. Repeated rows are each placed, and each written once. ``write_shards`` carries all
columns; where one is called like the partition column, that gets another name. Long texts count
with their bytes; ties cannot occur but between equal rows, whose order is any.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.llm.common import fresh, settled, text_of

KEY_BITS = 60
ROUND_BITS = 15
LIMIT_BYTES = 1 << 20


def hash_bits(c: Column) -> Column:
    """The first 60 bits of an MD5 as a whole number."""
    digest = F.md5(F.coalesce(c.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _prefix(depth: Column | int, first: Column, second: Column) -> Column:
    """The leading ``depth`` bits of the key, as text of 0 and 1."""
    bits = F.concat(F.lpad(F.bin(first), KEY_BITS, "0"), F.lpad(F.bin(second), KEY_BITS, "0"))
    return F.substring(bits, F.lit(1), F.lit(depth) if isinstance(depth, int) else depth)


def documents_to_place(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``_id, _h1, _h2, _bytes`` of each document, and the row itself as ``_row``."""
    text = text_of()
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if whole else []
    return docs.select(
        *row,
        F.col("doc_id").cast("long").alias("_id"), hash_bits(F.col("doc_id")).alias("_h1"),
        hash_bits(text).alias("_h2"), F.octet_length(text).cast("long").alias("_bytes"),
    )


def split_round(rows: DataFrame, top: int, limit: int) -> DataFrame:
    """The buckets of one round: ``_fine, _shard, _depth, _shard_bytes, _full``, one row per
    prefix of ``top + ROUND_BITS`` bits that occurs; rows share their first ``top`` bits
    only if they are of one bucket of the round before."""
    fine = top + ROUND_BITS
    counts = (
        rows.groupBy(_prefix(fine, F.col("_h1"), F.col("_h2")).alias("_fine"))
        .agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_n"))
    )
    up = counts.select("_fine", "_bytes", "_n", F.explode(F.sequence(F.lit(top), F.lit(fine))).alias("_depth"))
    up = up.withColumn("_shard", F.expr("substring(_fine, 1, _depth)"))
    nodes = up.groupBy("_depth", "_shard").agg(F.sum("_bytes").alias("_shard_bytes"), F.sum("_n").alias("_rows"))
    # the shallowest prefix within the limit or with one document; the deepest one if none is
    fits = up.join(nodes, ["_depth", "_shard"]).withColumn("_fits", (F.col("_shard_bytes") <= limit) | (F.col("_rows") == 1))
    pick = F.struct("_depth", "_shard", "_shard_bytes")
    best = fits.groupBy("_fine").agg(
        F.min(F.when(F.col("_fits"), pick)).alias("_in"), F.max(pick).alias("_deepest")
    )
    leaf = F.coalesce("_in", "_deepest")
    return best.select(
        "_fine", leaf["_shard"].alias("_shard"), leaf["_depth"].alias("_depth"),
        leaf["_shard_bytes"].alias("_shard_bytes"), F.col("_in").isNull().alias("_full"),
    )


def overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows of one full key: running bytes over the tasks' parts of the key.

    Equal rows may be numbered in any order. A page holds as many as fit; the parts of one
    key lie in many tasks, and only their counts meet.
    """
    # written first, so that a row keeps its part wherever it is read again
    part = settled(rows.withColumn("_part", F.spark_partition_id()), "overflow")
    counts = part.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("_n"), F.max("_bytes").alias("_most"))
    whole = Window.partitionBy("_shard")
    counts = counts.select(
        F.col("_shard").alias("_s"), F.col("_part").alias("_p"),
        (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n")).alias("_before"),
        F.greatest(F.floor(F.lit(limit) / F.greatest(F.max("_most").over(whole), F.lit(1))), F.lit(1)).alias("_per_page"),
    )
    numbered = part.withColumn("_i", F.row_number().over(Window.partitionBy("_shard", "_part").orderBy("_bytes")) - 1)
    out = numbered.join(counts, (F.col("_shard") == F.col("_s")) & (F.col("_part") == F.col("_p")))
    page = F.floor((F.col("_before") + F.col("_i")) / F.col("_per_page"))
    out = out.withColumn("_page", page.cast("long")).drop("_s", "_p", "_part", "_i", "_before", "_per_page")
    # a page is bounded by the limit, or by its number of empty rows
    return out.withColumn("_shard_bytes", F.sum("_bytes").over(Window.partitionBy("_shard", "_page")))


def place(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Each document with its shard: ``doc_id, shard`` (prefix bits, then ``.page`` for overflow),
    ``depth, n_bytes, shard_bytes``; the bytes of an overflow page are its own."""
    return _placed(documents_to_place(docs), limit).select(
        F.col("_id").alias("doc_id"), "shard", F.col("_depth").alias("depth"), F.col("_bytes").alias("n_bytes"),
        F.col("_shard_bytes").alias("shard_bytes"),
    )


def _placed(rest: DataFrame, limit: int) -> DataFrame:
    """Rows of ``documents_to_place`` with ``shard, _depth, _shard_bytes``."""
    columns = rest.columns
    done = []
    top = 0
    while True:
        buckets = settled(split_round(rest, top, limit), f"directory-{top}")
        top += ROUND_BITS
        at = rest.withColumn("_fine", _prefix(top, F.col("_h1"), F.col("_h2"))).join(buckets, "_fine").drop("_fine")
        done.append(at.filter(~F.col("_full")).withColumn("_page", F.lit(None).cast("long")))
        if buckets.filter("_full").isEmpty():
            break
        if top >= 2 * KEY_BITS:
            done.append(overflow(at.filter("_full"), limit))
            break
        rest = settled(at.filter("_full").select(*columns), "still-full")
    out = reduce(DataFrame.unionByName, done)
    paged = F.col("_page").isNotNull()
    return out.withColumn("shard", F.when(paged, F.concat_ws(".", "_shard", "_page")).otherwise(F.col("_shard")))


#: Partition column of written shards; to be read as text, since prefixes may start with 0.
SHARD_COLUMN = "_shard"


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> str:
    """Documents into one folder per shard, each row with the shard it was placed in; the rows of
    a shard meet in one task, which the byte limit bounds. The one shard of no prefix is called
    ``all``. Returns the name of the partition column."""
    column = fresh(docs, SHARD_COLUMN)
    name = F.when(F.col("shard") == "", "all").otherwise(F.col("shard"))
    rows = _placed(documents_to_place(docs, whole=True), limit).select("_row.*", name.alias(column))
    rows.repartition(column).write.partitionBy(column).parquet(path)
    return column
