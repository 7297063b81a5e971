"""Cutting a series into bounded pieces of time, so that no task holds a whole series.

A window over ``partitionBy(site)`` puts a whole series into one task; one long series may
hold a third of all rows. Here a series is cut by grid position into chunks of a fixed
number of steps, windows run over ``(site, chunk)``, and rows that a neighbouring chunk
must see (its halo) are sent along as marked copies in the same shuffle. A chunk has at
most ``chunk_steps`` rows plus its halo, whatever the series length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brimline.functions.time import floor_div

CHUNK = "_chunk"
HALO = "_halo"
CHUNK_STEPS = 3840  # 160 days of hours; under the 4096 rows a window buffers before spilling


def by_chunk(df: DataFrame, site: str) -> DataFrame:
    """The one shuffle by ``(site, chunk)``.

    Spelled out: hash(site) alone would satisfy a window over ``(site, chunk)``, so a join
    or grouping by site before it would otherwise keep a whole series together. The
    partition count is given because gap filling and windowing expand the rows after the
    shuffle, which adaptive coalescing cannot see from the shuffled bytes.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, site, CHUNK)


def with_halo(
    df: DataFrame,
    site: str,
    position: str,
    back: int = 0,
    ahead: int = 0,
    chunk_steps: int = CHUNK_STEPS,
    series_stats: DataFrame | None = None,
) -> DataFrame:
    """Rows keyed by chunk, shuffled once by ``(site, chunk)``.

    Each chunk also receives the ``back`` rows before it and the ``ahead`` rows after it,
    marked by ``_halo``. Drop them with :func:`core` once the windows are computed.

    ``series_stats`` (one row per site) is joined on the way. A join by site would gather a
    long series in one task; here the statistics are first spread to the chunks that
    exist, and meet the rows in the partitioning those need anyway.
    """
    pos = F.col(position).cast("bigint")
    first = F.greatest(floor_div(pos - F.lit(ahead), chunk_steps), F.lit(0).cast("bigint"))
    last = floor_div(pos + F.lit(back), chunk_steps)
    own = floor_div(pos, chunk_steps)
    placed = df.withColumn(CHUNK, F.explode(F.sequence(first, last)))
    rows = by_chunk(placed.withColumn(HALO, F.col(CHUNK) != own), site)
    if series_stats is None:
        return rows
    chunks = placed.select(site, CHUNK).distinct().join(series_stats, site)
    return rows.join(by_chunk(chunks, site), [site, CHUNK], "left")


def chunk_arrays(
    df: DataFrame,
    columns: list[str],
    site: str,
    position: str,
    back: int = 0,
    ahead: int = 0,
    chunk_steps: int = CHUNK_STEPS,
) -> DataFrame:
    """One row per chunk: ``_rows``, its rows and its halo as structs ``(position, _halo,
    columns)`` in order of position. Bounded like a chunk, and in the partitioning of
    :func:`with_halo`: what is made of the array crosses no further exchange.
    """
    names = list(dict.fromkeys(columns))
    chunked = with_halo(df.select(site, position, *names), site, position, back, ahead, chunk_steps)
    item = F.struct(position, HALO, *names)
    return chunked.groupBy(site, CHUNK).agg(F.sort_array(F.collect_list(item)).alias("_rows"))


def with_series(chunks: DataFrame, series: DataFrame, site: str) -> DataFrame:
    """Chunk rows with the columns of ``series`` (one row per site), which travel to the
    chunks by their keys first: the arrays of a long series never meet in one task."""
    spread = chunks.select(site, CHUNK).join(series, site)
    return chunks.join(spread, [site, CHUNK], "left")


def core(df: DataFrame) -> DataFrame:
    """Drop the halo copies and the chunk columns."""
    return df.filter(~F.col(HALO)).drop(CHUNK, HALO)


def chunk_window(site: str, order: str | Column, descending: bool = False):
    col = F.col(order) if isinstance(order, str) else order
    return Window.partitionBy(site, CHUNK).orderBy(col.desc() if descending else col.asc())
