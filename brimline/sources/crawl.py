"""Raw observation files to the canonical panel, with rejects kept apart.

Every file is read by its own header: one pass finds the first line of each file, and a
line's fields are then looked up by that header. A plain multi-file CSV read would map
later files by the position of the first file's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.functions.text import number
from brimline.functions.time import partial_timestamp, year_from_name
from brimline.operators.dedup import keep_last
from brimline.schema import (
    FLOAT_COLUMNS,
    GATE_COLUMNS,
    KNOWN_FUTURE,
    OBSERVED,
    PANEL_COLUMNS,
    RAW_COLUMNS,
    RAW_TO_PANEL,
    SITE,
    TIME,
    TIMEZONE,
    require,
)

# Fixed value: text that marks a failure row written between the records.
FAILURE_MARK = "{'vm': '84', 'lv': '23', 'hc': '4-47'"

_ORDER = ["_path", "_block", "_line_no"]


def dated_name(path: Column) -> Column:
    """The part of a path that carries the year: the file name, or the folder for part
    files (whose names are job ids, not dates)."""
    in_folder = F.regexp_extract(path, r"([^/]+)/part-[^/]*$", 1)
    return F.when(in_folder != "", in_folder).otherwise(F.regexp_extract(path, r"([^/]+)$", 1))


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = "*.csv") -> DataFrame:
    """Lines of CSV files with where they came from. No line at all is an error."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no input files")
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(paths)
    if lines.isEmpty():
        raise FileNotFoundError(f"no CSV lines in {', '.join(paths)}")
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line_no"),
    )


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def raw_fields(line: Column, most: Column | None = None) -> Column:
    """Fields of a CSV line, cut after ``most`` if given; empty ones stay empty strings.

    The line is cut at every comma. Only in a line with quotes are the parts gone through:
    those from one that opens a quote to the one that closes it are one field; a part with
    an even number of quotes neither opens nor closes. Each part is met once.
    """
    parts = F.split(line, ",", -1)

    def merged(parts: Column) -> Column:
        start = F.struct(
            F.array().cast("array<struct<a:int,b:int>>").alias("done"), F.lit(None).cast("int").alias("open")
        )
        room = (lambda s: F.size(s["done"]) < most) if most is not None else lambda s: F.lit(True)

        def step(s: Column, i: Column) -> Column:
            part = F.get(parts, i)
            odd = _quotes(part) % 2 == 1
            opens = s["open"].isNull() & part.startswith('"') & odd
            goes_on = s["open"].isNotNull() & ~odd
            ended = F.array_append(s["done"], F.struct(F.coalesce(s["open"], i).alias("a"), i.alias("b")))
            return F.struct(
                F.when(opens | goes_on | ~room(s), s["done"]).otherwise(ended).alias("done"),
                F.when(opens, i).when(goes_on, s["open"]).alias("open"),
            )

        # an unclosed quote: what is left is one field
        def close(s: Column) -> Column:
            rest = F.struct(s["open"].alias("a"), (F.size(parts) - 1).alias("b"))
            return F.when(s["open"].isNotNull() & room(s), F.array_append(s["done"], rest)).otherwise(s["done"])

        spans = F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step, close)
        fields = F.transform(spans, lambda r: F.array_join(F.slice(parts, r["a"] + 1, r["b"] - r["a"] + 1), ","))
        return F.transform(fields, _unquoted)

    plain = parts if most is None else F.slice(parts, F.lit(1), most)
    quoted = F.get(F.transform(F.array(parts), merged), F.lit(0))
    return F.when(line.contains('"'), quoted).otherwise(plain)


def _fields(line: Column) -> Column:
    """As :func:`raw_fields`, empty ones NULL."""
    return F.transform(raw_fields(line), lambda f: F.nullif(f, F.lit("")))


def _unquoted(field: Column) -> Column:
    """A field without its quotes."""
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
    plain = F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"')))
    return F.coalesce(plain, field)


def _value(at: Column) -> Column:
    """The field at a place from 1; NULL where it is empty, or the line or header lacks it."""
    return F.nullif(F.get("_fields", at - 1), F.lit(""))


def names_of(header: Column, renames: dict[str, str] | None = None) -> Column:
    """Column names of a header line, mapped to panel names."""
    raw = raw_fields(F.regexp_replace(header, "^\ufeff", ""))
    if not renames:
        return F.transform(raw, lambda c: F.coalesce(F.trim(c), F.lit("")))
    table = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])
    return F.transform(raw, lambda c: F.coalesce(F.element_at(table, F.trim(c)), F.trim(c), F.lit("")))


def headers_of(lines: DataFrame, renames: dict[str, str] | None = RAW_TO_PANEL) -> DataFrame:
    """First line with text of every file as an array of names: ``(_path, _header, _names)``.

    Only first blocks are looked at; each task brings one row per file to the shuffle.
    """
    first = (
        lines.filter((F.col("_block") == 0) & (F.trim("line") != ""))
        .groupBy("_path")
        .agg(F.min_by("line", "_line_no").alias("_header"))
    )
    return first.withColumn("_names", names_of(F.col("_header"), renames))


def with_places(headers: DataFrame) -> DataFrame:
    """``_at``: where each panel column stands in a file (NULL: nowhere), once per file."""
    at = lambda c: F.nullif(F.array_position("_names", c).cast("int"), F.lit(0)).alias(c)
    return headers.withColumns({"_at": F.struct(*map(at, PANEL_COLUMNS)), "_width": F.size("_names")})


def parse_lines(
    lines: DataFrame,
    tz: str = TIMEZONE,
    label_local_as_utc: bool = False,
    year_rollover: bool = False,
    strict: bool = False,
    drop_marked: bool = True,
) -> DataFrame:
    """Typed panel rows of raw lines, each with ``reject_reason`` (NULL when good).

    * Header names are mapped to panel names; unknown names are ignored.
    * Too many fields reject a line, too few are padded with NULL.
    * Times are local ``dd/MM HH:mm`` in the year of the file name and become UTC instants;
      ``label_local_as_utc`` keeps the wall time and calls it UTC. ``year_rollover`` takes
      a December row of a January file into the year before.
    * Numbers that do not parse are NULL; a column the file lacks is 0.
    * A file without time or site column, or without a year in its name, is rejected, or
      fails the job with ``strict``.
    """
    # One row per file: Spark sends it to all tasks or joins by path, and then splits a file
    # that dominates.
    headers = with_places(headers_of(lines)).drop("_names")
    joined = lines.join(headers, "_path").filter(F.col("line") != F.col("_header"))
    return typed_lines(joined, tz, label_local_as_utc, year_rollover, strict, drop_marked)


def typed_lines(
    joined: DataFrame, tz: str, label_local_as_utc: bool = False, year_rollover: bool = False,
    strict: bool = False, drop_marked: bool = True, keep: list[str] = (),
) -> DataFrame:
    """Lines that know their file's header (``_header``, and what :func:`with_places` adds) as
    typed panel rows."""
    with_fields = joined.filter(F.trim("line") != "").withColumns(
        {"_fields": raw_fields(F.col("line"), F.col("_width") + 1), "_name": dated_name(F.col("_path"))}
    )
    place = lambda c: F.col(f"_at.{c}")
    value = lambda c: _value(place(c))

    year = year_from_name(F.col("_name"))
    file_reason = (
        F.when(place(TIME).isNull(), "no timestamp column")
        .when(place(SITE).isNull(), "no site column")
        .when(year.isNull(), "no year in file name")
    )
    if strict:
        why = F.concat(file_reason, F.lit(": "), F.col("_path"))
        file_reason = F.when(file_reason.isNotNull(), F.raise_error(why).cast("string"))
    failure = F.col("line").contains(FAILURE_MARK) if drop_marked else F.lit(False)
    raw_time = value(TIME)
    if year_rollover:
        file_month = F.regexp_extract("_name", r"20[0-9]{2}[-_]?([0-9]{2})", 1)
        late = raw_time.rlike(r"^\d{1,2}/12") & (file_month == "01")
        year = year - late.cast("int")
    wall = partial_timestamp(raw_time, year)
    instant = wall if label_local_as_utc else F.to_utc_timestamp(wall, tz)
    numbers = {}
    for c in FLOAT_COLUMNS:
        numbers[c] = F.when(place(c).isNotNull(), number(value(c))).otherwise(0.0)
    for c in GATE_COLUMNS:
        x = number(value(c))
        whole = F.when(x == F.floor(x), x.try_cast("bigint"))
        numbers[c] = F.when(place(c).isNotNull(), whole).otherwise(F.lit(0).cast("bigint"))
    typed = with_fields.withColumns({TIME: instant, SITE: value(SITE), **numbers})
    reason = (
        F.when(file_reason.isNotNull(), file_reason)
        .when(failure, "failure row")
        .when(F.size("_fields") > F.col("_width"), "too many fields")
        .when(F.col(TIME).isNull(), "bad timestamp")
    )
    return typed.select(*PANEL_COLUMNS, reason.alias("reject_reason"), "line", *_ORDER, *keep)


def panel_of(parsed: DataFrame) -> DataFrame:
    """Good rows, one per site and time: the last line of the last file in path order wins."""
    good = parsed.filter(F.col("reject_reason").isNull()).select(*PANEL_COLUMNS, *_ORDER)
    return keep_last(good, [SITE, TIME], _ORDER, drop=_ORDER).select(*PANEL_COLUMNS)


def rejects_of(parsed: DataFrame) -> DataFrame:
    """Lines that are not observations, with the reason and the file."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", "line", F.col("_path").alias("path")
    )


def read_crawl(spark: SparkSession, paths: str | list[str], tz: str = TIMEZONE, **options) -> DataFrame:
    """Canonical panel of a folder (or a list of uploaded files) of raw CSV files."""
    return panel_of(parse_lines(read_lines(spark, paths), tz, **options))


def read_panel(
    spark: SparkSession,
    path: str | list[str],
    default_site: str = "SITE_001",
    numeric: list[str] = (*FLOAT_COLUMNS, *OBSERVED, *KNOWN_FUTURE),
) -> DataFrame:
    """Panel CSV as written by the canonical sink, or by hand: ``timestamp`` is required
    (ISO text, bad -> NULL) and ``site_id`` defaults. Gates are integers, ``numeric``
    columns doubles (bad -> NULL), anything else stays text. Every file is read by its own
    header; a column it lacks is NULL.
    """
    lines = read_lines(spark, path, glob=None)
    headers = headers_of(lines, renames=None)
    # the distinct names, in the order of the first file that has them: a handful of strings
    at = headers.select("_path", F.posexplode("_names").alias("_i", "_c")).filter("_c != ''")
    order = at.groupBy("_c").agg(F.min(F.struct("_path", "_i")).alias("_first")).orderBy("_first")
    names = [r["_c"] for r in order.collect()]
    rows = lines.join(headers, "_path").filter((F.col("line") != F.col("_header")) & (F.trim("line") != ""))
    rows = rows.select("_names", raw_fields(F.col("line")).alias("_fields"))

    def value(name: str) -> Column:
        return _value(F.nullif(F.array_position("_names", name).cast("int"), F.lit(0))).alias(name)

    site = F.when(F.array_contains("_names", SITE), value(SITE)).otherwise(F.lit(default_site)).alias(SITE)
    raw = rows.select(*[site if c == SITE else value(c) for c in names], *([] if SITE in names else [site]))
    require(raw, TIME)
    typed = {TIME: F.col(TIME).try_cast("timestamp")}
    typed |= {c: number(F.col(c)) for c in numeric if c in raw.columns}
    typed |= {c: number(F.col(c)).try_cast("bigint") for c in GATE_COLUMNS if c in raw.columns}
    return raw.withColumns(typed)


def records_to_panel(
    records: DataFrame, poll_time: str = "poll_time", tz: str = TIMEZONE, label_local_as_utc: bool = False
) -> DataFrame:
    """Typed records of extracted pages to panel rows; the year is that of the poll."""
    wall = partial_timestamp(F.col(TIME), F.year(F.from_utc_timestamp(F.col(poll_time), tz)))
    instant = wall if label_local_as_utc else F.to_utc_timestamp(wall, tz)
    renamed = records.withColumnsRenamed(RAW_TO_PANEL).withColumn(TIME, instant)
    gates = {c: F.col(c).cast("bigint") for c in GATE_COLUMNS}
    return renamed.withColumns(gates).select(*PANEL_COLUMNS, *[c for c in records.columns if c not in RAW_COLUMNS])
