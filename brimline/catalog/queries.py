"""One query per operator over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brimline.catalog.inputs import (
    SHIFT,
    comparable,
    events_panel,
    observation_pages,
    orders_panel,
    raw_values,
    table,
    users_panel,
    write_crawl_files,
)
from brimline.functions.stats import grouped_quantiles
from brimline.functions.text import (
    expand_colspans,
    header_field,
    looks_like_data,
    normalize_text,
    tolerant_float,
    tolerant_int,
)
from brimline.operators import covariates as cv
from brimline.operators import evaluate as ev
from brimline.operators import forecast as fc
from brimline.operators.dedup import head_steps, keep_last, tail, union_all
from brimline.operators.features import add_calendar, add_lags_rollings, add_position, fill_features
from brimline.operators.grid import regularize
from brimline.operators.profile import profile
from brimline.operators.quantile_model import QuantileForecaster
from brimline.operators.split import (
    apply_scalers,
    fit_moments,
    fit_scalers,
    scalers_of,
    split_by_date,
    split_by_ratio,
    unscale,
)
from brimline.operators.windows import (
    cutoff_of_bounds,
    has_gaps,
    inference_frame,
    mark_future,
    normalize_target,
    training_cutoff,
    window_arrays,
    window_rows,
)
from brimline.plans.prepare import prepare, prepare_splits
from brimline.plans.request import answer_request
from brimline.schema import GATE_COLUMNS, LENGTH, POSITION, SITE, TARGET, TIME, column_groups
from brimline.session import scratch_path, use_utc
from brimline.sources import crawl, pages, sinks
from brimline.streaming.coverage import coverage_by_month, expected_polls
from brimline.streaming.ingest import (
    hourly_stream,
    ingest_stream,
    read_updates,
    write_updates,
)

QUERIES = {}

ENC, DEC = 24, 12
HORIZON, SEASON = 24, 24


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: comparable(fn(use_utc(spark), sf_dir))
    return fn


def regular_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularize(events_panel(spark, sf_dir))


def split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_by_ratio(regular_events(spark, sf_dir))


def scaled_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar(split_events(spark, sf_dir))


def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.backtest_persistence(split_events(spark, sf_dir), HORIZON)


def gates_as_double(df: DataFrame) -> DataFrame:
    """Integer columns that may be NULL as doubles, which compare alike everywhere."""
    return df.withColumns({c: F.col(c).cast("double") for c in GATE_COLUMNS})


# --- sources -------------------------------------------------------------------------


@query
def crawl_ingest(spark, sf_dir):
    return gates_as_double(crawl.read_crawl(spark, write_crawl_files(spark, sf_dir)))


@query
def crawl_rejects(spark, sf_dir):
    lines = crawl.read_lines(spark, write_crawl_files(spark, sf_dir))
    rejects = crawl.rejects_of(crawl.parse_lines(lines))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def upload_batch(spark, sf_dir):
    root = write_crawl_files(spark, sf_dir)
    return gates_as_double(crawl.read_crawl(spark, [f"{root}/a", f"{root}/b"]))


@query
def panel_csv_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "canonical")
    sinks.write_canonical_csv(events_panel(spark, sf_dir), root)
    return crawl.read_panel(spark, root)


@query
def page_records(spark, sf_dir):
    rows = pages.extract_rows(observation_pages(spark, sf_dir), keep=["poll_time"])
    panel = crawl.records_to_panel(pages.records(rows, keep=["page_id", "poll_time"]))
    return gates_as_double(panel.drop("page_id", "poll_time"))


@query
def month_append(spark, sf_dir):
    root = scratch_path(spark, "months")
    rows = pages.extract_rows(observation_pages(spark, sf_dir), keep=["poll_time"])
    sinks.append_records(pages.records(rows, keep=["poll_time"]), root)
    return gates_as_double(crawl.read_crawl(spark, root))


@query
def poll_batches(spark, sf_dir):
    """Polls by day in two batches, the first appended twice; what the folders hold then."""
    root = scratch_path(spark, "polls")
    polls = observation_pages(spark, sf_dir).withColumns(
        {"status_code": F.lit(200), "params": F.col("page_id"), "content": F.col("html")}
    )
    early = F.dayofmonth("poll_time") <= 15
    for batch_id, some in (("a", polls.filter(early)), ("a", polls.filter(early)), ("b", polls.filter(~early))):
        records = pages.records(pages.extract_rows(some, keep=["poll_time"]), keep=["page_id", "poll_time"])
        sinks.append_polls(some, records, f"{root}/records", f"{root}/failures", batch_id)
    read = lambda kind: spark.read.option("header", True).option("multiLine", True).csv(f"{root}/{kind}/batch=*/month=*")
    counted = lambda kind: read(kind).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return counted("records").unionByName(counted("failures"))


@query
def poll_failures(spark, sf_dir):
    polls = observation_pages(spark, sf_dir)
    rows = pages.extract_rows(polls)
    described = polls.select(
        "page_id", "poll_time", F.lit(200).alias("status_code"),
        F.concat(F.lit("{'td': '"), "page_id", F.lit("'}")).alias("params"), F.col("html").alias("content"),
    )
    failed = sinks.failure_rows(described, pages.records(rows, keep=["page_id"]))
    return failed.withColumn("content", F.md5("content"))


# --- text and numbers ----------------------------------------------------------------


@query
def normalized_text(spark, sf_dir):
    plain = normalize_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(plain).alias("plain_md5"))


@query
def header_fields(spark, sf_dir):
    # Every word of every document as a header; most map to nothing.
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    named = words.select(header_field(F.col("word")).alias("field"))
    return named.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query
def expanded_headers(spark, sf_dir):
    cell = lambda text, span: F.struct(F.col(text).alias("text"), span.cast("int").alias("colspan"))
    cells = F.array(
        cell("o_orderstatus", F.length("o_orderpriority") % 3 + 1),
        cell("o_orderpriority", F.dayofmonth("o_orderdate") % 4 + 1),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.array_join(expand_colspans(cells), "|").alias("header"))


@query
def data_rows(spark, sf_dir):
    cells = F.array(
        F.col("o_orderpriority"), F.format_number("o_totalprice", 2), F.col("o_custkey").cast("string"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.lit("")),
        F.col("o_orderstatus"),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        looks_like_data(cells, 5).alias("is_data"),
        looks_like_data(cells, 20).alias("is_data_wide"),
    )


@query
def tolerant_numbers(spark, sf_dir):
    price = F.when(F.col("l_returnflag") == "R", F.concat(F.lit(" "), F.format_number("l_extendedprice", 2), F.lit(" ")))
    text = F.coalesce(price, F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice").cast("string")), F.lit("n/a"))
    items = table(spark, sf_dir, "lineitem").withColumn("text", text)
    return items.select(
        "l_orderkey", "l_linenumber",
        tolerant_float(F.col("text")).alias("as_float"), tolerant_int(F.col("text")).cast("double").alias("as_int"),
    )


# --- dedup, union, head and tail -----------------------------------------------------


@query
def keep_last_rows(spark, sf_dir):
    base = table(spark, sf_dir, "events").select(
        F.col("event_type").alias(SITE), F.date_trunc("hour", F.col("ts")).alias(TIME), "value", "event_id"
    )
    again = base.withColumns({"value": F.col("value") + 1, "event_id": -F.col("event_id")})
    both = union_all(base.withColumn("version", F.lit(0)), again.withColumn("version", F.lit(1)))
    return keep_last(both, [SITE, TIME], ["version", "event_id"])


@query
def union_frames(spark, sf_dir):
    p = events_panel(spark, sf_dir).select(SITE, TIME, TARGET)
    q = users_panel(spark, sf_dir).select(SITE, TIME, "luu_luong_den")
    every = union_all(p, q)
    return every.groupBy(TIME).agg(
        F.count(F.lit(1)).alias("n"), F.count(TARGET).alias("n_target"), F.sum("luu_luong_den").alias("inflow")
    )


@query
def series_tail(spark, sf_dir):
    return tail(regular_events(spark, sf_dir), 168).select(SITE, TIME, TARGET)


@query
def series_tail_irregular(spark, sf_dir):
    return tail(users_panel(spark, sf_dir), 24).select(SITE, TIME, TARGET)


@query
def forecast_head(spark, sf_dir):
    return head_steps(fc.seasonal_forecast(split_events(spark, sf_dir), SEASON, 48, 48), 12)


# --- regular grid --------------------------------------------------------------------


@query
def regular_panel_events(spark, sf_dir):
    return regular_events(spark, sf_dir)


@query
def regular_panel_users(spark, sf_dir):
    return regularize(users_panel(spark, sf_dir))


@query
def regular_panel_two_hourly(spark, sf_dir):
    return regularize(users_panel(spark, sf_dir), "2H")


@query
def regular_panel_orders_daily(spark, sf_dir):
    return regularize(orders_panel(spark, sf_dir), "1D", limit=1)


@query
def grid_without_fill(spark, sf_dir):
    return regularize(events_panel(spark, sf_dir), fill=False)


# --- features ------------------------------------------------------------------------


@query
def calendar_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias(TIME))
    return add_calendar(orders)


@query
def lag_rolling_events(spark, sf_dir):
    return prepare(events_panel(spark, sf_dir).select(SITE, TIME, TARGET)).select(
        SITE, TIME, TARGET, *[f"{TARGET}_lag_{n}" for n in (1, 3, 6, 24, 48, 168)],
        *[f"{TARGET}_rolling_{s}_{n}" for n in (3, 12, 24, 168) for s in ("mean", "std")],
    )


@query
def lag_rolling_users(spark, sf_dir):
    return prepare(users_panel(spark, sf_dir).select(SITE, TIME, TARGET)).select(
        SITE, TIME, f"{TARGET}_lag_24", f"{TARGET}_rolling_mean_24", f"{TARGET}_rolling_std_24",
        f"{TARGET}_rolling_mean_168", f"{TARGET}_rolling_std_168",
    )


@query
def lag_rolling_irregular(spark, sf_dir):
    rows = users_panel(spark, sf_dir).select(SITE, TIME, "luu_luong_den")
    return add_lags_rollings(rows, "luu_luong_den", [1, 3], [3, 12])


@query
def filled_features(spark, sf_dir):
    rows = add_lags_rollings(regular_events(spark, sf_dir).select(SITE, TIME, TARGET, POSITION, LENGTH))
    cols = [c for c in rows.columns if c.startswith(f"{TARGET}_")]
    return fill_features(rows, cols).drop(LENGTH)


@query
def filled_forward(spark, sf_dir):
    rows = users_panel(spark, sf_dir)
    return fill_features(rows, ["luu_luong_den"], backward=False)


@query
def series_position(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias(SITE), F.col("ts").alias(TIME), "event_id")
    return add_position(rows)


@query
def series_position_segments(spark, sf_dir):
    """Event types are long against the limit given, so they are ranked by segments."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias(SITE), F.col("ts").alias(TIME), "event_id")
    return add_position(rows, whole=100).groupBy(SITE, TIME, LENGTH).agg(
        F.min(POSITION).alias("first_idx"), F.max(POSITION).alias("last_idx")
    )


# --- splits and scaling --------------------------------------------------------------


@query
def ratio_split(spark, sf_dir):
    return split_events(spark, sf_dir).select(SITE, TIME, "split")


@query
def ratio_split_irregular(spark, sf_dir):
    return split_by_ratio(users_panel(spark, sf_dir)).select(SITE, TIME, "split")


@query
def date_split(spark, sf_dir):
    rows = split_by_date(events_panel(spark, sf_dir), "2024-01-15 12:00:00", "2024-01-22 00:00:00")
    return rows.select(SITE, TIME, "split")


@query
def scaler_statistics(spark, sf_dir):
    return fit_scalers(scaled_inputs(spark, sf_dir).filter(F.col("split") == "train"))


@query
def scaler_moments(spark, sf_dir):
    """Moments per month and day, written part by part, put together again."""
    root = scratch_path(spark, "moments")
    rows = scaled_inputs(spark, sf_dir).filter(F.col("split") == "train").withColumn("day", F.to_date(TIME).cast("string"))
    early = F.dayofmonth(TIME) <= 10
    for some in (rows.filter(early), rows.filter(~early)):
        fit_moments(some, "day").write.mode("append").parquet(root)
    return scalers_of(spark.read.parquet(root))


@query
def scaled_panel(spark, sf_dir):
    rows = scaled_inputs(spark, sf_dir)
    stats = fit_scalers(rows.filter(F.col("split") == "train"))
    return apply_scalers(rows, stats).select(
        SITE, TIME, "split", TARGET, "luu_luong_den", "xa_tran", "so_cua_xa_mat", "was_imputed",
        "muc_dang_binh_thuong", "hour_sin", "doy_cos", "is_weekend",
    )


@query
def split_sink(spark, sf_dir):
    paths = sinks.write_splits(scaled_inputs(spark, sf_dir), scratch_path(spark, "splits"), scaled=True)
    raw, scaled = (spark.read.parquet(paths[k]) for k in ("raw", "scaled"))
    both = raw.withColumn("copy", F.lit("raw")).unionByName(scaled.withColumn("copy", F.lit("scaled")), True)
    return both.groupBy("copy", "split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("mean_target"), F.avg("hour_sin").alias("mean_hour_sin")
    )


@query
def column_roles(spark, sf_dir):
    rows = prepare_splits(events_panel(spark, sf_dir), lags=[1, 24], windows=[24])
    return profile(rows, column_groups(rows), ["split"])


@query
def manifest_profile(spark, sf_dir):
    """Rows and manifest written side by side; a later job takes the columns from the manifest."""
    rows = scaled_inputs(spark, sf_dir)
    written = sinks.write_splits(rows, scratch_path(spark, "rows"))["raw"]
    listed = sinks.read_manifest(spark, sinks.write_manifest(rows, scratch_path(spark, "manifest")))
    columns = sinks.manifest_columns(listed)
    groups = {}
    for role, column in columns.select("role", "column").collect():  # names, as many as the schema has
        groups.setdefault(role, []).append(column)
    figures = profile(spark.read.schema(rows.schema).parquet(written), groups, ["split"])
    return figures.join(columns.drop("quantiles"), ["role", "column"])


# --- windows -------------------------------------------------------------------------


@query
def cutoff(spark, sf_dir):
    return training_cutoff(regular_events(spark, sf_dir), DEC)


@query
def cutoff_users(spark, sf_dir):
    return cutoff_of_bounds(users_panel(spark, sf_dir), DEC)


def _windows(only):
    def run(spark, sf_dir):
        ends = cutoff_of_bounds(events_panel(spark, sf_dir).select(SITE, TIME), DEC)
        rows = window_rows(regular_events(spark, sf_dir), ENC, DEC, only=only, cutoff=ends)
        return rows.select(SITE, "origin_idx", "step", TIME, TARGET, "relative_idx")

    run.__name__ = f"windows_{only}"
    return query(run)


for _only in ("train", "validation", "last"):
    _windows(_only)


@query
def windows_strided(spark, sf_dir):
    rows = window_rows(regular_events(spark, sf_dir), ENC, DEC, stride=DEC)
    return rows.select(SITE, "origin_idx", "step", TIME, TARGET)


@query
def windows_per_site_cutoff(spark, sf_dir):
    rows = window_rows(regularize(users_panel(spark, sf_dir)), ENC, DEC, only="validation", per_site=True)
    return rows.groupBy(SITE, "origin_idx").agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("total"))


@query
def window_array_form(spark, sf_dir):
    rows = window_arrays(regular_events(spark, sf_dir), [TARGET], ENC, DEC)
    join = lambda c: F.array_join(
        F.transform(c, lambda s: F.floor((s[TARGET] + SHIFT) * 1e6).cast("string")), "|"
    )
    return rows.select(SITE, "origin_idx", F.md5(join("encoder")).alias("encoder"), F.md5(join("decoder")).alias("decoder"))


@query
def window_arrays_two_weeks(spark, sf_dir):
    """A week behind and two ahead, one window a day, of every user."""
    rows = window_arrays(regularize(users_panel(spark, sf_dir).select(SITE, TIME, TARGET)), [TARGET], 168, 336, stride=24)
    value = lambda c, i: F.element_at(c, i)[TARGET].alias(f"{c}_{'first' if i == 1 else 'last'}")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + F.coalesce(x[TARGET], F.lit(0.0)) * x["step"]).alias(f"{c}_total")
    parts = [f for c in ("encoder", "decoder") for f in (value(c, 1), value(c, -1), total(c), F.size(c).alias(f"{c}_size"))]
    return rows.select(SITE, "origin_idx", *parts)


@query
def normalized_target(spark, sf_dir):
    rows = normalize_target(regular_events(spark, sf_dir))
    return rows.select(SITE, TIME, f"{TARGET}_norm")


@query
def position_gaps(spark, sf_dir):
    # Observed rows of the grid: gaps are the stretches that were filled in.
    observed = regularize(users_panel(spark, sf_dir).select(SITE, TIME, TARGET)).filter(F.col("was_imputed") == 0)
    return has_gaps(observed).select(SITE, TIME, "gap_before")


@query
def inference_rows(spark, sf_dir):
    panel = events_panel(spark, sf_dir).select(SITE, TIME, TARGET, "luu_luong_den")
    last_day = F.lit("2024-01-29").cast("timestamp")
    history = panel.filter(F.col(TIME) < last_day)
    future = panel.filter(F.col(TIME) >= last_day).select(SITE, TIME, F.col("luu_luong_den").alias("rain_forecast_mm"))
    marked = mark_future(regularize(inference_frame(history, future)))
    stats = fit_scalers(marked.filter(~F.col("is_future")).select(TARGET))
    return apply_scalers(marked, stats).select(SITE, TIME, "is_future", TARGET)


# --- forecasts -----------------------------------------------------------------------


@query
def persistence(spark, sf_dir):
    rows = split_events(spark, sf_dir)
    return fc.attach_actuals(fc.persistence_forecast(rows, HORIZON, HORIZON), rows)


@query
def persistence_two_weeks(spark, sf_dir):
    """Chunks shorter than the series, so that their summaries have to agree on the ranks."""
    return fc.persistence_forecast(split_events(spark, sf_dir), 336, chunk_steps=168)


@query
def persistence_users(spark, sf_dir):
    rows = split_by_ratio(regularize(users_panel(spark, sf_dir).select(SITE, TIME, TARGET)))
    return fc.persistence_forecast(rows, 336)


@query
def seasonal(spark, sf_dir):
    rows = split_events(spark, sf_dir)
    return fc.attach_actuals(fc.seasonal_forecast(rows, SEASON, 2 * HORIZON, 2 * HORIZON), rows)


@query
def seasonal_users(spark, sf_dir):
    rows = split_by_ratio(regularize(users_panel(spark, sf_dir).select(SITE, TIME, TARGET)))
    return fc.seasonal_forecast(rows, 168, 336)


@query
def climatology(spark, sf_dir):
    rows = split_events(spark, sf_dir)
    return fc.attach_actuals(fc.climatology_forecast(rows, HORIZON, 14, HORIZON), rows)


@query
def persistence_backtest(spark, sf_dir):
    return backtest(spark, sf_dir)


@query
def seasonal_backtest(spark, sf_dir):
    return fc.backtest_seasonal(split_events(spark, sf_dir), HORIZON, 12)


FEATURES = [f"{TARGET}_lag_1", f"{TARGET}_lag_24", f"{TARGET}_rolling_mean_12", f"{TARGET}_rolling_std_24"]


@query
def learned_forecast(spark, sf_dir):
    rows = prepare_splits(events_panel(spark, sf_dir).select(SITE, TIME, TARGET), lags=[1, 24], windows=[12, 24])
    model = fc.DirectForecaster(FEATURES, HORIZON).fit(rows)
    return model.forecast(rows, holdout=HORIZON)


@query
def quantile_forecast(spark, sf_dir):
    """Level at the origin and inflow of the target hour, known ahead, to quantiles of the level."""
    model = QuantileForecaster([], HORIZON, ["luu_luong_den"], ["y_origin", "label_luu_luong_den"], iterations=4)
    rows = split_events(spark, sf_dir)
    return model.fit(rows).forecast(rows, holdout=HORIZON)


def issued_inflow(spark, sf_dir):
    """Inflow forecasts of every hour, issued 6, 30 and 54 hours before it."""
    panel = events_panel(spark, sf_dir).select(SITE, TIME, "luu_luong_den")
    lead = F.explode(F.array(F.lit(6), F.lit(30), F.lit(54))).alias("lead")
    rows = panel.select("*", lead)
    return rows.select(
        SITE, TIME, (F.col(TIME) - F.make_interval(hours=F.col("lead"))).alias("issued"),
        (F.col("luu_luong_den") + F.col("lead")).alias("rain_forecast_mm"),
    )


@query
def covariates_as_issued(spark, sf_dir):
    root = scratch_path(spark, "covariates")
    rows, issued = regular_events(spark, sf_dir).select(SITE, TIME, TARGET, POSITION, LENGTH), issued_inflow(spark, sf_dir)
    daily = F.col(POSITION) % 24 == 0
    known = cv.training_covariates(rows, issued, ["rain_forecast_mm"], 48, origin_filter=daily)
    # the last two days of the panel stand in for the future
    ends = rows.filter(F.col(POSITION) < F.col(LENGTH) - 48)
    ahead = cv.inference_covariates(ends, issued, ["rain_forecast_mm"], 48)
    paths = sinks.write_known_future(known, ahead, root)
    out = [spark.read.parquet(p).select(SITE, "origin_ts", "step", "issued_at", "rain_forecast_mm", F.lit(k).alias("part")) for k, p in paths.items()]
    return union_all(*out)


@query
def as_of_rows(spark, sf_dir):
    """Each event with the last hourly mean of its type known by then."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias(SITE), F.col("ts").alias(TIME))
    hourly = events_panel(spark, sf_dir).select(SITE, (F.col(TIME) + F.expr("interval 1 hour")).alias("known"), TARGET)
    return cv.as_of(rows, hourly.filter(F.col(TARGET) > 50), [TARGET], given_time="known")


@query
def request_forecast(spark, sf_dir):
    """The last two days asked for: only the end of each series is prepared, with scalers and
    spread of the training."""
    panel = events_panel(spark, sf_dir).select(SITE, TIME, TARGET, "luu_luong_den")
    begin = F.lit("2024-01-29").cast("timestamp")
    history, after = panel.filter(F.col(TIME) < begin), panel.filter(F.col(TIME) >= begin)
    future = after.select(SITE, TIME, F.col("luu_luong_den").alias("rain_forecast_mm"))
    train = split_by_ratio(regularize(history.select(SITE, TIME, TARGET))).filter(F.col("split") == "train")
    stats = fit_scalers(train.select(TARGET))
    spread = fc.seasonal_spread(apply_scalers(train, stats), 2, SEASON)
    answer = lambda past, ahead: fc.seasonal_forecast(past, SEASON, 48, spread=spread)
    return answer_request(history, future, stats, answer, SEASON).drop("origin_idx")


@query
def selected_model(spark, sf_dir):
    rows = split_events(spark, sf_dir)
    scored = union_all(
        fc.backtest_persistence(rows, HORIZON, labels_inside=True).withColumn("model", F.lit("persistence")),
        fc.backtest_seasonal(rows, HORIZON, SEASON, labels_inside=True).withColumn("model", F.lit("seasonal")),
    )
    return fc.select_model(scored.filter(F.col("y").isNotNull()))


@query
def candidate_losses(spark, sf_dir):
    """The loss of every candidate on the validation rows, the learned one among them."""
    rows = split_events(spark, sf_dir)
    learned = QuantileForecaster([], HORIZON, ["luu_luong_den"], ["y_origin", "label_luu_luong_den"], iterations=4).fit(rows)
    scored = union_all(
        fc.backtest_persistence(rows, HORIZON, labels_inside=True).withColumn("model", F.lit("persistence")),
        fc.backtest_seasonal(rows, HORIZON, SEASON, labels_inside=True).withColumn("model", F.lit("seasonal")),
        learned.backtest(rows, "val", labels_inside=True).withColumn("model", F.lit("linear")),
    )
    losses = ev.mean_pinball().alias("loss")
    return scored.filter(F.col("y").isNotNull()).groupBy("model").agg(losses)


@query
def future_steps(spark, sf_dir):
    return fc.future_timestamps(users_panel(spark, sf_dir), 48)


@query
def forecast_envelope(spark, sf_dir):
    # The q50 and q90 bands swapped, as of a model whose quantiles cross.
    keys = [SITE, "origin_idx", "step"]
    crossed = backtest(spark, sf_dir).select(*keys, "q10", F.col("q90").alias("q50"), F.col("q50").alias("q90"))
    sorted_median = fc.envelope(crossed, non_crossing=True).withColumnRenamed("median", "sorted_median")
    return fc.envelope(sorted_median.drop("lower", "upper")).select(*keys, "lower", "median", "upper", "sorted_median")


@query
def unscaled_forecast(spark, sf_dir):
    rows = scaled_inputs(spark, sf_dir)
    stats = fit_scalers(rows.filter(F.col("split") == "train"))
    forecast = fc.seasonal_forecast(apply_scalers(rows, stats), SEASON, HORIZON, HORIZON)
    return unscale(forecast, stats, fc.BANDS)


@query
def known_future_rows(spark, sf_dir):
    panel = events_panel(spark, sf_dir)
    # Rain per clock time as a covariate: the inflow total of the same hour, a day later.
    rain = panel.groupBy((F.col(TIME) + F.expr("interval 1 day")).alias(TIME)).agg(
        F.sum("luu_luong_den").alias("rain_forecast_mm")
    )
    return fc.known_future(panel, 48, covariates=rain).drop("hour", "dow", "doy")


@query
def holidays(spark, sf_dir):
    # Busy days stand in for a holiday table.
    orders = table(spark, sf_dir, "orders")
    busy = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 10")
    return fc.add_holidays(orders.select("o_orderkey", F.col("o_orderdate").alias(TIME)), busy)


@query
def forecast_sink(spark, sf_dir):
    path = sinks.write_forecast(backtest(spark, sf_dir), scratch_path(spark, "forecast"), fmt="parquet")
    return spark.read.parquet(path)


# --- evaluation ----------------------------------------------------------------------


@query
def forecast_metrics(spark, sf_dir):
    return ev.metrics(backtest(spark, sf_dir), horizons={"6h": 6, "12h": 12, "14d": 336})


@query
def forecast_metrics_scaled(spark, sf_dir):
    rows = scaled_inputs(spark, sf_dir)
    stats = fit_scalers(rows.filter(F.col("split") == "train"))
    forecast = fc.backtest_persistence(apply_scalers(rows, stats), HORIZON)
    return ev.metrics(forecast, horizons={}).select("mae", "rmse", "coverage", "interval_width", "n_scored")


@query
def metrics_by_step(spark, sf_dir):
    return ev.metrics_by_step(backtest(spark, sf_dir))


@query
def metrics_report(spark, sf_dir):
    row = ev.metrics(backtest(spark, sf_dir))
    paths = sinks.write_metrics(row, scratch_path(spark, "metrics"))
    return spark.read.text(paths["text"])


@query
def error_histogram(spark, sf_dir):
    return ev.error_histogram(backtest(spark, sf_dir))


@query
def error_qq(spark, sf_dir):
    return ev.normal_qq(backtest(spark, sf_dir))


@query
def error_qq_line(spark, sf_dir):
    return ev.qq_line(ev.normal_qq(backtest(spark, sf_dir)))


@query
def error_pairs(spark, sf_dir):
    return ev.error_pairs(backtest(spark, sf_dir))


@query
def pair_limits(spark, sf_dir):
    return ev.pair_limits(backtest(spark, sf_dir))


@query
def signed_errors(spark, sf_dir):
    return ev.signed_errors(backtest(spark, sf_dir), [SITE, "origin_idx"])


@query
def uncertainty_summary(spark, sf_dir):
    rows = ev.uncertainty(fc.envelope(backtest(spark, sf_dir)), [SITE, "origin_idx"])
    return ev.uncertainty_summary(rows)


# --- streams -------------------------------------------------------------------------


def _drain(writer) -> None:
    stream = writer.trigger(availableNow=True).start()
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()


@query
def stream_latest(spark, sf_dir):
    root = scratch_path(spark, "landing")
    raw = raw_values(events_panel(spark, sf_dir))

    def poll():
        _drain(ingest_stream(spark, f"{root}/in", f"{root}/out", f"{root}/state"))

    sinks.append_records(raw, f"{root}/in")
    poll()
    revised = raw.filter(F.col("muc_nuoc_thuong_luu") > 50)
    changed = revised.withColumn("muc_nuoc_thuong_luu", F.col("muc_nuoc_thuong_luu") + 1)
    sinks.append_records(changed, f"{root}/in")
    poll()
    return read_updates(spark, f"{root}/out").select(SITE, TIME, TARGET, "luu_luong_den", "so_cua_xa_mat")


@query
def stream_rejects(spark, sf_dir):
    root = scratch_path(spark, "rejected")
    _drain(ingest_stream(spark, write_crawl_files(spark, sf_dir), f"{root}/out", f"{root}/state", f"{root}/rejects"))
    rejects = spark.read.option("basePath", f"{root}/rejects").parquet(f"{root}/rejects")
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_hourly(spark, sf_dir):
    root = scratch_path(spark, "hourly")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    events = source.withColumn("ts", F.col("ts").cast("timestamp"))
    panes = hourly_stream(events, "event_type", "ts", "value")
    _drain(write_updates(panes, f"{root}/out", f"{root}/state"))
    updates = spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out")
    return keep_last(updates, ["event_type", TIME], ["batch_id"], drop=["batch_id"])


@query
def grouped_quantiles_large(spark, sf_dir):
    """Groups well above the size that one sketch answers exactly."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return grouped_quantiles(lines, ["l_returnflag"], "l_extendedprice", [0.05, 0.1, 0.5, 0.9, 0.999], ["p05", "p10", "p50", "p90", "p999"])


@query
def poll_coverage(spark, sf_dir):
    received = table(spark, sf_dir, "events").select(F.date_trunc("minute", F.col("ts")).alias("poll_time"))
    expected = expected_polls(spark, "2023-12-31 00:00:00", "2024-02-01 00:00:00", "10min")
    return coverage_by_month(expected, received)
