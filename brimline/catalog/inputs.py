"""Panels and raw files derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brimline.functions.time import local
from brimline.schema import RAW_COLUMNS, SITE, TIME, TIMEZONE
from brimline.session import scratch_path, use_utc
from brimline.sources.crawl import FAILURE_MARK

SHIFT = 3.3e-8
RAW_HEADER = ",".join(RAW_COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its naive timestamps read as UTC instants."""
    df = use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at six decimals and naive UTC times, so that two engines' values compare.

    Means of two-decimal values often end in a 5 at the seventh decimal, where the last
    bit decides the rounding; the small shift moves them off that edge on both sides.
    """
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols[f.name] = F.round(F.col(f.name) + F.lit(SHIFT), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            cols[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(cols)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly panel, one series per event type."""
    v = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias(SITE), hour_of(F.col("ts")).alias(TIME))
        .agg(
            F.avg(v).alias("muc_thuong_luu"),
            F.max(F.length("event_type")).cast("double").alias("muc_dang_binh_thuong"),
            F.sum(v).alias("luu_luong_den"),
            F.max(v).alias("tong_luong_xa"),
            F.avg(F.when(v > 60, v)).alias("xa_tran"),
            F.count(F.lit(1)).alias("so_cua_xa_mat"),
        )
    )


def users_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly panel, one sparse series per user."""
    v = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias(SITE), hour_of(F.col("ts")).alias(TIME))
        .agg(
            F.avg(v).alias("muc_thuong_luu"),
            F.avg(F.when(F.col("event_type") == "view", v)).alias("luu_luong_den"),
        )
    )


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily panel, one series per order priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias(SITE), F.col("o_orderdate").alias(TIME))
        .agg(F.avg("o_totalprice").alias("muc_thuong_luu"))
    )


def raw_values(panel: DataFrame) -> DataFrame:
    """Events panel as raw records: source names, local ``dd/MM HH:mm`` text, month key."""
    wall = local(F.col(TIME), TIMEZONE)
    return panel.select(
        F.col(SITE).alias("ten_ho"),
        F.date_format(wall, "dd/MM HH:mm").alias("timestamp"),
        F.round("muc_thuong_luu", 4).alias("muc_nuoc_thuong_luu"),
        F.col("muc_dang_binh_thuong").alias("muc_nuoc_dang_binh_thuong"),
        F.lit(1.5).alias("muc_nuoc_chet"),
        F.round("luu_luong_den", 4).alias("luu_luong_den_ho"),
        F.round("tong_luong_xa", 4).alias("tong_luong_xa"),
        F.round("xa_tran", 4).alias("tong_luong_xa_qua_dap_tran"),
        F.lit(0.25).alias("tong_luong_xa_qua_nha_may"),
        F.lit(0).alias("so_cua_xa_sau"),
        F.col("so_cua_xa_mat").cast("int").alias("so_cua_xa_mat"),
        F.date_format(wall, "yyyy-MM").alias("month"),
        F.col(TIME).alias("poll_time"),
    )


def write_crawl_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw files in three layouts under one folder, read in path order:

    ``a``: every hour, full header. ``b``: revised rows of hours with a mean over 50, other
    column order, columns missing, some values bad. ``c``: raw lines: short lines of hours
    with a sum over 500, lines with too many fields, failure rows, impossible dates.
    """
    root = scratch_path(spark, "crawl")
    panel = events_panel(spark, sf_dir)
    raw = raw_values(panel)
    _csv(raw.select(*RAW_COLUMNS, "month"), f"{root}/a")
    revised = raw.filter(F.col("muc_nuoc_thuong_luu") > 50)
    level = F.when(F.col("tong_luong_xa") > 200, F.lit("bad")).otherwise(
        (F.col("muc_nuoc_thuong_luu") + 1).cast("string")
    )
    _csv(
        revised.select(
            "timestamp", F.lit("late, revised").alias("note"), "ten_ho",
            (F.col("tong_luong_xa") + 1).alias("tong_luong_xa"),
            level.alias("muc_nuoc_thuong_luu"), "month",
        ),
        f"{root}/b",
    )
    site, stamp = F.col("ten_ho"), F.col("timestamp")
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS]
    lines = F.filter(
        F.array(
            F.when(F.col("luu_luong_den_ho") > 500, F.concat_ws(",", site, F.replace(stamp, F.lit(" ")), F.lit("7.5"))),
            F.when(F.col("so_cua_xa_mat") > 2, F.concat_ws(",", *values, F.lit("9"))),
            F.when(
                F.col("so_cua_xa_mat") == 2,
                F.concat(F.date_format("poll_time", "yyyy-MM-dd HH:mm"), F.lit(f',500,"{FAILURE_MARK}}}",error, no table')),
            ),
            F.when(F.col("so_cua_xa_mat") == 1, F.concat_ws(",", site, F.lit("31/02 10:00"), F.lit("1"))),
        ),
        lambda x: x.isNotNull(),
    )
    _csv(
        raw.select(F.explode(lines).alias(RAW_HEADER), "month"),
        f"{root}/c", sep="\u0001", quote="\u0002",
    )
    return root


def _csv(df: DataFrame, path: str, **options) -> None:
    df.write.partitionBy("month").options(header=True, **options).csv(path)


def observation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one observation table per series and day (at most 24 data rows each),
    beside the given ``pages``, which have none."""
    raw = raw_values(events_panel(spark, sf_dir)).withColumn("_day", F.to_date("poll_time"))

    def td(c: str, thousands: bool = False) -> Column:
        text = F.format_number(F.col(c), 4) if thousands else F.col(c).cast("string")
        return F.concat(F.lit('<td class="tdclass"> '), F.coalesce(text, F.lit("")), F.lit("</td>"))

    name = F.concat(F.lit("<td><b>"), F.col("ten_ho"), F.lit("</b><br /><small>Đồng bộ lúc: 17:30</small></td>"))
    commas = ("muc_nuoc_thuong_luu", "luu_luong_den_ho", "tong_luong_xa", "tong_luong_xa_qua_dap_tran")
    cells = [td(c, c in commas) for c in RAW_COLUMNS[1:]]
    row = F.concat(F.lit("<tr>"), name, *cells, F.lit("</tr>"))
    header = "".join(f"<th>{t}</th>" for t in ["Tên hồ", "Thời điểm", *[f"Cột {i}" for i in range(9)]])
    top = f'<table class="tblgridtd"><tr>{header}</tr><tr><td colspan="11"><strong>Vùng 1</strong></td></tr>'
    made = raw.groupBy("ten_ho", "_day").agg(
        F.array_join(F.sort_array(F.collect_list(row)), "").alias("_rows"),
        F.max("poll_time").alias("poll_time"),
    )
    made = made.select(
        F.concat_ws("/", "ten_ho", F.col("_day").cast("string")).alias("page_id"),
        F.concat(F.lit(f"<html><table><tr><td>menu</td></tr></table>{top}"), "_rows", F.lit("</table></html>")).alias("html"),
        "poll_time",
    )
    given = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("page_id"), "html",
        F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 7200).alias("poll_time"),
    )
    return made.unionByName(given)
