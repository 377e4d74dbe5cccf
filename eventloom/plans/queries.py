"""Every operator as a named query over the test tables: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventloom.functions import columns as fc, text as ft, vectors as fv
from eventloom.operators import clean, embed, features, learning, quality, retrieval, search, semantic, stats, tree
from eventloom.plans import jobs, models
from eventloom.plans.refresh import DailyModels
from eventloom.schema import EVENT_SCHEMA, EVENT_TYPES, RECORD_SCHEMA
from eventloom.session import scratch_path
from eventloom.sources import events as se, layout, records, testtables, warehouse
from eventloom.sources.testtables import TEST_ROLES, raw_events, table, user_events
from eventloom.sources.fileset import FileSet
from eventloom.sources.increments import IncrementalLoad
from eventloom.sources.stored import RecordLog
from eventloom.streaming import alerts, jobs as sj
from eventloom.streaming.live import FirstArrivals, LiveWindows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-02-01"
RUN_TS = "2024-02-01 00:00:00"
EVENT_COLUMNS = tuple(EVENT_SCHEMA.names)
CLEAN_COLUMNS = (
    "event_id", "user_id", "event_type", "product_id", "event_ts", "page", "referrer", "duration_ms", "device", "browser",
)


def _edge(df: DataFrame) -> DataFrame:
    """Zone-free times and plain doubles, the types results are compared in."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_events(raw_events(spark, d), run_ts=_run_ts())


def _stg(spark: SparkSession, d: str) -> DataFrame:
    return models.stg_user_events(user_events(spark, d))


def _folded(spark: SparkSession, d: str) -> DataFrame:
    """Events with their types folded, as cleaning leaves them."""
    return user_events(spark, d).withColumn("event_type", F.lower("event_type"))


def _users(spark: SparkSession, d: str) -> DataFrame:
    return models.dim_users(_stg(spark, d))


def _products(spark: SparkSession, d: str) -> DataFrame:
    return models.dim_products(_stg(spark, d), TEST_ROLES)


# --- cleaning --------------------------------------------------------------------------------


def clean_events(spark, d):
    return _edge(_cleaned(spark, d).select(*CLEAN_COLUMNS, "processing_date"))


def clip_duration(spark, d):
    return clean.clean_events(raw_events(spark, d), mode="clip").select("event_id", "duration_ms")


def parse_timestamps(spark, d):
    parsed = raw_events(spark, d).select(
        "event_id", fc.parse_event_ts("timestamp").alias("event_ts"), fc.lenient_ts("timestamp").alias("lenient_ts")
    )
    return _edge(parsed.withColumn("epoch", fc.epoch_seconds("event_ts")))


def dedup_events(spark, d):
    ev = user_events(spark, d).select("event_id", "event_type", "page", "event_ts")
    late = ev.withColumn("event_ts", F.col("event_ts") + F.expr("interval 1 hour")).withColumn("page", F.lit("copy"))
    return _edge(clean.dedup(clean.union_all(late, ev)))


def cleaning_report(spark, d):
    return clean.cleaning_report(raw_events(spark, d), F.to_date(fc.parse_event_ts("timestamp")))


# --- sources and sinks -----------------------------------------------------------------------


def read_jsonl_roundtrip(spark, d):
    path = scratch_path(spark, "jsonl")
    se.write_events_json(raw_events(spark, d).select(*EVENT_COLUMNS), path)
    return se.read_events_json(spark, path)


def partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "partitioned")
    dated = _cleaned(spark, d).select(*CLEAN_COLUMNS, "processing_date")
    se.write_events(dated, path)
    return _edge(spark.read.parquet(path).select(*CLEAN_COLUMNS, "processing_date"))


def recursive_read(spark, d):
    path = scratch_path(spark, "tree")
    ev = user_events(spark, d)
    nested = ev.select(
        F.col("event_id").alias("EVENT_ID"), F.col("user_id").alias("User_Id"),
        F.when(F.col("k") < 3, F.lit(float("nan"))).otherwise(F.col("value")).alias("VALUE"),
        F.lower("event_type").alias("kind"), F.col("device").alias("gear"),
    )
    nested.hint("rebalance", "kind", "gear").write.partitionBy("kind", "gear").parquet(path)
    return se.read_parquet_tree(spark, path)


def glob_view(spark, d):
    """Events asked by SQL over the files that a glob names: the partitions of two types."""
    path = scratch_path(spark, "glob")
    se.write_events(_cleaned(spark, d), path, by=("event_type",), replace="all")
    se.glob_view(spark, f"{path}/event_type={{view,click}}/*.parquet", "globbed_events")
    return spark.sql("SELECT device, COUNT(*) AS events, SUM(duration_ms) AS duration_ms FROM globbed_events GROUP BY device")


def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    columns = ("event_id", "user_id", "event_type", "product_id", "referrer", "duration_ms")
    se.write_csv(raw_events(spark, d).select(*columns), path)
    read = se.read_csv(spark, path, columns)
    return read.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def _scratch_table(spark: SparkSession, label: str) -> tuple[str, str]:
    path = scratch_path(spark, label)
    return path.rsplit("/", 1)[-1].replace("-", "_") + ".user_events", path


def warehouse_load(spark, d):
    name, path = _scratch_table(spark, "load")
    raw = raw_events(spark, d)
    warehouse.create_raw_table(spark, name, path)
    warehouse.load_warehouse(clean.union_all(raw, raw), name, _run_ts())
    return _edge(warehouse.read_table(spark, name))


def table_migration(spark, d):
    name, path = _scratch_table(spark, "migrate")
    warehouse.migrate_table(_cleaned(spark, d).select(*CLEAN_COLUMNS, "processing_date"), name, path=path)
    return _edge(warehouse.read_table(spark, name))


def table_append(spark, d):
    name, path = _scratch_table(spark, "append")
    rows = _cleaned(spark, d).select("event_id", "event_type", "duration_ms")
    warehouse.migrate_table(rows, name, by=("event_type",), path=path)
    warehouse.append_rows(rows.withColumn("event_id", F.concat("event_id", F.lit("-b"))), name, by=("event_type",))
    return warehouse.read_table(spark, name)


def incremental_read(spark, d):
    ev = user_events(spark, d).select("event_id", "user_id", "event_ts")
    return _edge(warehouse.read_since(ev, "event_ts", F.lit("2024-01-16 12:00:00").cast("timestamp")))


def _increments(spark: SparkSession, d: str) -> IncrementalLoad:
    """Events in two increments, with a run in between that breaks off before its commit."""
    ev = _shaped(spark, d).select("event_id", "user_id", "event_type", "event_ts")
    load = IncrementalLoad(spark, scratch_path(spark, "increments"), ev.schema)
    middle = ev.agg(F.expr("timestamp_micros(cast((unix_micros(min(event_ts)) + unix_micros(max(event_ts))) / 2 as bigint))")).first()[0]
    early, some = ev.filter(F.col("event_ts") <= F.lit(middle)), ev.filter("cast(event_id as long) % 3 = 0")
    load.run(early)
    # The lost run: an intent and a part of its rows.
    low, high = load.mark().first()["mark"], ev.agg(F.max("event_ts")).first()[0]
    load.intents.put(spark.createDataFrame([(low, high)], load.intents.schema), 1)
    load.loaded.put(some.filter(F.col("event_ts") > F.lit(low)), 1)
    load.run(ev)
    return load


def incremental_load(spark, d):
    return _edge(_increments(spark, d).rows())


def stored_mark(spark, d):
    return _edge(_increments(spark, d).mark())


def high_water_mark(spark, d):
    return _edge(warehouse.high_water_mark(user_events(spark, d), "event_ts"))


def table_sample(spark, d):
    return se.sample_rows(user_events(spark, d).select("event_id", "user_id", "event_type"), 5000, "event_id")


def table_head(spark, d):
    user_events(spark, d).select("event_id", "user_id", "event_type").createOrReplaceTempView("head_events")
    return warehouse.read_table(spark, "head_events", limit=1000, order=("event_id",))


def source_availability(spark, d):
    stg = _stg(spark, d)
    tables = {
        "dim_users": models.dim_users(stg),
        "dim_products": models.dim_products(stg, TEST_ROLES),
        "fct_user_events_daily": models.fct_user_events_daily(stg),
        "no_such_table": "no_such_table",
    }
    return warehouse.availability(spark, tables).select("table_name", "row_count", "available")


def collection_stats(spark, d):
    return table(spark, d, "embeddings").agg(
        F.count("*").alias("num_entities"),
        F.min(F.size("embedding")).alias("min_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
        F.count_distinct("label").alias("labels"),
    )


def collection_report(spark, d):
    """A stored collection and one that is not there."""
    return search.collection_report(spark, {"user_events": f"{d}/embeddings.parquet", "product_features": f"{d}/no_such_collection.parquet"})


def cleaning_output(spark, d):
    """What the cleaned events take on disk against JSON lines; the bytes themselves differ from writer to writer."""
    path = scratch_path(spark, "cleaned")
    rows = se.write_events(_cleaned(spark, d), path)
    report = layout.written_report(spark, path, rows)
    return report.select("clean_rows", "raw_estimate_mb", "usable", (F.col("files") > 0).alias("has_files"), F.col("compression_pct").between(0.1, 99.9).alias("smaller"))


def output_inspection(spark, d):
    path = scratch_path(spark, "inspect")
    rows = se.write_events(_cleaned(spark, d), path)
    return layout.inspect_output(spark, path).select("usable", F.lit(rows).cast("long").alias("written"))


def _read_back(report: DataFrame, label: str, base: str) -> DataFrame:
    """Add the rows each labelled folder holds."""
    spark = report.sparkSession
    counts = None
    for (name,) in report.select(label).collect():
        n = spark.read.parquet(f"{base}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias(label), "rows")
        counts = n if counts is None else counts.unionByName(n)
    return report.select(label, "usable").join(counts, label)


def codec_sizes(spark, d):
    base = scratch_path(spark, "codecs")
    return _read_back(layout.codec_sizes(_cleaned(spark, d), base), "codec", base)


def layout_report(spark, d):
    base = scratch_path(spark, "layouts")
    return _read_back(layout.layout_report(user_events(spark, d), base), "layout", base)


def compaction_report(spark, d):
    base = scratch_path(spark, "compact")
    _cleaned(spark, d).repartition(32).write.parquet(f"{base}/before")
    layout.compact(spark, f"{base}/before", f"{base}/after")
    report = layout.compaction_report(spark, f"{base}/before", f"{base}/after")
    return _read_back(report, "stage", base)


def small_file_merge(spark, d):
    """Rows of a file set whose small files have been merged: half of them came in one piece, half in many."""
    rows = _cleaned(spark, d).select("event_id", "event_type", "product_id", "event_ts", "duration_ms")
    half = F.pmod(F.col("event_id").cast("long"), F.lit(2))
    files = FileSet(spark, scratch_path(spark, "fileset"), rows.schema, by=("event_type",))
    files.add(rows.filter(half == 0).hint("rebalance", "event_type"))
    small = files.files().agg(F.min("bytes")).first()[0]
    files.add(rows.filter(half == 1).repartition(16))
    files.merge_small(small)
    return _edge(files.read())


def kafka_roundtrip(spark, d):
    sent = records.encode_records(raw_events(spark, d).select(*EVENT_COLUMNS))
    return records.decode_records(sent)


# --- models and statistics -------------------------------------------------------------------


def stg_user_events(spark, d):
    return _edge(_stg(spark, d))


def dim_users(spark, d):
    return _users(spark, d)


def dim_products(spark, d):
    return _products(spark, d)


def fct_user_events_daily(spark, d):
    return models.fct_user_events_daily(_stg(spark, d))


def segment_totals(spark, d):
    return stats.segment_totals(_users(spark, d))


def user_segments(spark, d):
    return stats.user_segments(_users(spark, d))


def events_by_type(spark, d):
    return stats.events_by_type(fct_user_events_daily(spark, d))


def top_products(spark, d):
    return stats.top_products(_products(spark, d))


def top_users(spark, d):
    return stats.top_users(_users(spark, d))


def top_users_page_2(spark, d):
    return stats.top_users(_users(spark, d), n=20, offset=20)


def product_rank(spark, d):
    return stats.product_rank(_products(spark, d), user_events(spark, d, category=True))


def row_count(spark, d):
    return stats.row_count(table(spark, d, "events"))


def dashboard_overview(spark, d):
    return stats.overview(_folded(spark, d), TEST_ROLES)


def sales_trend(spark, d):
    return stats.trend(_folded(spark, d))


def hourly_histogram(spark, d):
    return stats.hourly(user_events(spark, d))


def hourly_heatmap(spark, d):
    return stats.heatmap(_folded(spark, d))


def daily_event_count(spark, d):
    return stats.daily_count(user_events(spark, d), F.to_date("event_ts"), "event_date")


def user_activity_rank(spark, d):
    return stats.activity_rank(user_events(spark, d))


def event_type_distribution(spark, d):
    return stats.type_distribution(_folded(spark, d))


def category_share(spark, d):
    return stats.category_share(user_events(spark, d, category=True).withColumn("event_type", F.lower("event_type")))


def funnel(spark, d):
    return stats.funnel(_folded(spark, d), TEST_ROLES)


def funnel_union(spark, d):
    return stats.funnel_union(_folded(spark, d), TEST_ROLES)


def funnel_step_rates(spark, d):
    return stats.step_rates(stats.funnel(_folded(spark, d), TEST_ROLES))


def filter_agg_device(spark, d):
    out = stats.filter_agg(_folded(spark, d), F.col("event_type") == "purchase", "device", "value")
    return out.select("device", F.round("sum_value", 4).alias("sum_value"), F.round("avg_value", 6).alias("avg_value"), "cnt")


def agg_type_device(spark, d):
    out = stats.multi_key_agg(_folded(spark, d), ["event_type", "device"], "value")
    return out.withColumn("sum_value", F.round("sum_value", 4))


def duration_stats(spark, d):
    return stats.duration_stats(_folded(spark, d))


# --- quality ---------------------------------------------------------------------------------


def _results(df: DataFrame) -> DataFrame:
    return df.select("rule", "column", "failures", "passed")


def dq_not_null(spark, d):
    rules = [quality.Rule("not_null", c) for c in ("event_id", "user_id", "event_type", "product_id", "referrer")]
    return _results(quality.run_suite(raw_events(spark, d), rules))


def dq_unique(spark, d):
    rules = [quality.Rule("unique", c) for c in ("event_id", "user_id", "product_id")]
    return _results(quality.run_suite(raw_events(spark, d), rules))


def dq_accepted_values(spark, d):
    rules = [quality.Rule("accepted_values", "event_type", EVENT_TYPES), quality.Rule("accepted_values", "referrer", ("google", "direct"))]
    return _results(quality.run_suite(raw_events(spark, d), rules))


def dq_ranges(spark, d):
    rules = [
        quality.Rule("min_between", "duration_ms", low=0, high=100),
        quality.Rule("max_between", "duration_ms", low=0, high=1_000_000),
        quality.Rule("row_count_between", low=1),
        quality.Rule("ordered_columns", values=EVENT_COLUMNS),
    ]
    return _results(quality.run_suite(raw_events(spark, d), rules))


def dq_suite(spark, d):
    cleaned = _cleaned(spark, d).select(*quality.USER_EVENT_COLUMNS)
    return _results(quality.run_suite(cleaned, quality.USER_EVENT_SUITE))


def dq_summary(spark, d):
    return quality.suite_summary(quality.run_suite(_stg(spark, d), quality.MODEL_RULES["user_events"]))


def dq_models(spark, d):
    """All rules declared for the source and the models, each model checked in its own passes."""
    stg = _stg(spark, d)
    frames = {
        "user_events": user_events(spark, d),
        "stg_user_events": stg,
        "dim_users": models.dim_users(stg),
        "fct_user_events_daily": models.fct_user_events_daily(stg),
        "dim_products": models.dim_products(stg, TEST_ROLES),
    }
    out = None
    for name, rules in quality.MODEL_RULES.items():
        part = _results(quality.run_suite(frames[name], rules)).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def dq_failures(spark, d):
    rules = [r for r in quality.USER_EVENT_SUITE if r.kind in quality.ROW_RULES]
    return quality.failing_values(raw_events(spark, d).select("event_id", "user_id", "event_type", "device"), rules)


def dq_stored_failures(spark, d):
    """Violations written below a folder and read back; for the unique rule each key with its number of rows."""
    rules = [r for r in quality.USER_EVENT_SUITE if r.kind in quality.ROW_RULES] + [quality.Rule("unique", "product_id")]
    path = scratch_path(spark, "failures")
    quality.store_failures(raw_events(spark, d).select("event_id", "user_id", "event_type", "product_id", "device"), rules, path)
    rows = spark.read.parquet(f"{path}/rows").select("rule", F.col("event_id").alias("key"), "value")
    keys = spark.read.parquet(f"{path}/unique_product_id")
    return rows.unionByName(keys.select(F.lit("unique:product_id").alias("rule"), F.col("product_id").alias("key"), F.col("n_records").cast("string").alias("value")))


def dq_duplicates(spark, d):
    return quality.failing_rows(raw_events(spark, d), quality.Rule("unique", "product_id"))


# --- features --------------------------------------------------------------------------------


def _user_frame(spark: SparkSession, d: str) -> DataFrame:
    return features.user_features(_users(spark, d), _as_of())


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def user_features(spark, d):
    return _rounded(_user_frame(spark, d), "activity_score")


def user_features_fractional(spark, d):
    out = features.user_features(_users(spark, d), F.lit("2024-02-01 06:00:00"), whole_days=False, limit=100)
    return _rounded(out, "days_since_first_seen", "days_since_last_seen", "activity_score")


def product_features(spark, d):
    return features.product_features(_products(spark, d))


def feature_service_user(spark, d):
    users = _users(spark, d)
    base = features.FeatureView("user_features", users, "user_id", ("user_segment", "total_events"))
    derived = features.FeatureView("user_derived", _user_frame(spark, d), "user_id", ("days_since_last_seen", "activity_score"))
    svc = features.FeatureService("user_profile_service", ((base, base.columns), (derived, derived.columns)))
    return _rounded(features.service(users.select("user_id"), svc), "activity_score")


def feature_service_product(spark, d):
    products = features.product_features(_products(spark, d))
    base = features.FeatureView("product_features", products, "product_id", ("total_views", "total_purchases", "conversion_rate_pct"))
    derived = features.FeatureView("product_derived", products, "product_id", ("popularity_tier", "purchase_view_ratio"))
    svc = features.FeatureService("product_recommendation_service", ((base, base.columns), (derived, derived.columns)))
    return features.service(products.select("product_id"), svc)


def feature_lookup(spark, d):
    stg = _stg(spark, d)
    buyers = stg.filter((F.col("event_type") == "purchase") & (F.col("device") == "mobile")).select("user_id")
    return _rounded(features.user_features(models.dim_users(stg), _as_of(), ids=buyers), "activity_score")


def _event_view(stg: DataFrame, ttl: int | None = None) -> features.FeatureView:
    views = stg.filter(F.col("event_type") == "view").withColumnRenamed("event_id", "view_id")
    return features.FeatureView("view", views, "user_id", ("view_id", "product_id", "duration_ms"), "event_ts", ttl)


def feature_latest(spark, d):
    return _edge(features.latest(_event_view(_stg(spark, d)), tie=("view_id",)))


def feature_online(spark, d):
    """Newest feature rows as stored for serving, looked up for the users that have bought on a mobile device."""
    stg = _stg(spark, d)
    path = scratch_path(spark, "online")
    features.materialize(_event_view(stg), path, tie=("view_id",))
    buyers = stg.filter((F.col("event_type") == "purchase") & (F.col("device") == "mobile")).select("user_id")
    return _edge(features.lookup(spark.read.parquet(path), "user_id", buyers))


def feature_historical(spark, d):
    """Two views joined onto the purchases as of their time."""
    stg = _stg(spark, d)
    clicks = stg.filter(F.col("event_type") == "click").withColumnRenamed("event_id", "click_id")
    click = features.FeatureView("click", clicks, "user_id", ("click_id", "page"), "event_ts", 86_400)
    ties = {"view": ("view_id",), "click": ("click_id",)}
    return _edge(features.historical(_purchases(stg), [_event_view(stg), click], "as_of", ties))


def _purchases(stg: DataFrame) -> DataFrame:
    bought = stg.filter(F.col("event_type") == "purchase")
    return bought.select("event_id", "user_id", F.col("event_ts").alias("as_of"))


def feature_point_in_time(spark, d):
    stg = _stg(spark, d)
    return _edge(features.point_in_time(_purchases(stg), _event_view(stg), "as_of", tie=("view_id",)))


def feature_point_in_time_ttl(spark, d):
    stg = _stg(spark, d)
    return _edge(features.point_in_time(_purchases(stg), _event_view(stg, ttl=86_400), "as_of", tie=("view_id",)))


def feature_point_in_time_hot(spark, d):
    """The same join where one user has nine of ten events and all of them lie in one hour."""
    stg = _stg(spark, d)
    one = F.when(F.pmod(F.col("event_id").cast("long"), F.lit(10)) == 0, F.col("user_id")).otherwise(F.lit("hot"))
    hour = F.unix_micros(F.lit("2024-01-15 10:00:00").cast("timestamp")) + F.unix_micros(F.col("event_ts").cast("timestamp")) % 3_600_000_000
    stg = stg.withColumns({"user_id": one, "event_ts": F.timestamp_micros(hour)})
    return _edge(features.point_in_time_pieces(_purchases(stg), _event_view(stg), "as_of", tie=("view_id",)))


def recommendation_inputs(spark, d):
    users, products = features.recommendation_inputs(_user_frame(spark, d), features.product_features(_products(spark, d)))
    as_rows = [
        users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("user_segment").alias("label"), F.round("activity_score", 6).alias("score")),
        products.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), F.col("popularity_tier").alias("label"), F.col("purchase_view_ratio").alias("score")),
    ]
    return as_rows[0].unionByName(as_rows[1])


def feature_summary(spark, d):
    return features.feature_summary(_user_frame(spark, d), "user_segment", "activity_score")


def on_demand_udf(spark, d):
    def derive(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"purchase_share": (pdf["total_purchases"] / pdf["total_interactions"]).round(6)})

    return features.on_demand(_products(spark, d), derive, ("total_purchases", "total_interactions"), "purchase_share double").select(
        "product_id", "purchase_share"
    )


def training_frame(spark, d):
    out = learning.training_frame(_users(spark, d), _as_of())
    return _rounded(out, "days_since_first_seen", "days_since_last_seen", "events_per_day", "recency_score", "activity_score")


# --- classifier ------------------------------------------------------------------------------

# Thresholds that give the test users several segments.
LEARNING_CUTS = (80, 68, 58)


def _training(spark: SparkSession, d: str) -> DataFrame:
    return learning.training_frame(models.dim_users(_stg(spark, d), LEARNING_CUTS), _as_of())


def training_split(spark, d):
    frame = _training(spark, d)
    train, test = learning.stratified_split(frame)
    sides = train.select("user_segment", F.lit(0).alias("is_test")).unionByName(test.select("user_segment", F.lit(1).alias("is_test")))
    return sides.groupBy("user_segment").agg(F.count("*").alias("users"), F.sum("is_test").alias("test_users"))


def _fitted(spark: SparkSession, d: str) -> tuple[learning.SegmentModel, DataFrame]:
    train, test = learning.stratified_split(_training(spark, d))
    model = learning.fit_segment_model(train)
    return model, model.predict(test)


def segment_model_metrics(spark, d):
    return learning.evaluate(_fitted(spark, d)[1])


def segment_model_report(spark, d):
    return learning.class_report(_fitted(spark, d)[1])


def _rule_made(spark: SparkSession, d: str) -> DataFrame:
    """A prediction with known errors: the segments under other thresholds."""
    stg = _stg(spark, d)
    guess = models.dim_users(stg, (84, 66, 60)).select("user_id", F.col("user_segment").alias("predicted"))
    return models.dim_users(stg, LEARNING_CUTS).select("user_id", "user_segment").join(guess, "user_id")


def rule_report(spark, d):
    out = learning.class_report(_rule_made(spark, d))
    return out.select(F.col(out.columns[0]).alias("segment"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), F.round("f1", 9).alias("f1"), "support")


def rule_metrics(spark, d):
    out = learning.evaluate(_rule_made(spark, d))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns if c != "rows"], F.col("rows").alias("users"))


def segment_model_importance(spark, d):
    return _fitted(spark, d)[0].importance(spark)


def segment_cv(spark, d):
    mean, dev = learning.cross_validate(learning.stratified_split(_training(spark, d))[0])
    return spark.createDataFrame([(learning.FOLDS, float(mean), float(dev))], "folds int, cv_f1_mean double, cv_f1_std double")


def segment_run_record(spark, d):
    base = scratch_path(spark, "runs")
    model, predicted = _fitted(spark, d)
    metrics = learning.evaluate(predicted).first().asDict()
    params = {"trees": learning.TREES, "max_depth": learning.MAX_DEPTH, "min_leaf": learning.MIN_LEAF, "seed": learning.SEED}
    learning.record_run(spark, base, "run-1", params, metrics, model)
    return spark.read.parquet(f"{base}/runs")


# --- text and vectors ------------------------------------------------------------------------


def event_text(spark, d):
    return ft.event_text(raw_events(spark, d)).select("event_id", "text_content")


def product_text(spark, d):
    return ft.product_text(_products(spark, d)).select("product_id", "text_content")


def event_chunks(spark, d):
    return ft.event_chunks(user_events(spark, d, category=True)).select("event_id", "chunk_no", "chunk")


def event_chunks_short(spark, d):
    """Limits tight enough that sentences gain an id or fall into several chunks."""
    return ft.event_chunks(user_events(spark, d, category=True), lo=80, hi=120).select("event_id", "chunk_no", "chunk")


def chunk_length_stats(spark, d):
    return stats.length_stats(event_chunks(spark, d), "chunk")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")


def _mean_vectors(df: DataFrame, key: str) -> DataFrame:
    """Mean vector per key: one vectorised aggregate."""
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return df.groupBy(key).agg(mean.alias("m")).select(key, vector_to_array("m").alias("embedding"))


def _label_queries(spark: SparkSession, d: str) -> DataFrame:
    """One question per label: the mean of its vectors."""
    return _mean_vectors(_corpus(spark, d), "label").withColumn("query_id", F.col("label").cast("long"))


def vector_normalize(spark, d):
    doubled = F.transform("embedding", lambda x: x * 3)
    unit = fv.l2_normalize(doubled)
    return _corpus(spark, d).select(
        "id", F.round(fv.inner_product(unit, unit), 6).alias("norm"), F.round(fv.inner_product(unit, F.col("embedding")), 5).alias("same"),
        F.round(F.element_at(unit, 1), 5).alias("first_x"),
    )


def _hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def vector_topk_exact(spark, d):
    return _hits(search.topk_exact(_corpus(spark, d), _label_queries(spark, d), 10))


def vector_topk_dirty(spark, d):
    """The exact search with every vector's copies that cannot be scored: not a number, a null, one element short."""
    corpus = _corpus(spark, d).select("id", "embedding")
    spoiled = [F.transform("embedding", lambda x: x * float("nan")), F.transform("embedding", lambda x: F.when(x > 0, x)), F.expr("slice(embedding, 1, size(embedding) - 1)")]
    for i, bad in enumerate(spoiled, 1):
        corpus = corpus.unionByName(_corpus(spark, d).select((-F.col("id") * 10 - i).alias("id"), bad.alias("embedding")))
    return _hits(search.topk_exact(corpus, _label_queries(spark, d), 10))


def vector_topk_filtered(spark, d):
    return _hits(search.topk_exact(_corpus(spark, d), _label_queries(spark, d), 10, where=F.col("label") < 5))


# Clusters of the pruned search on the test vectors, and how many a query looks into.
TEST_NLIST = 16
TEST_NPROBE = 6


def _ivf(spark: SparkSession, d: str, nprobe: int) -> DataFrame:
    index = search.build_ivf(_corpus(spark, d), scratch_path(spark, "ivf"), TEST_NLIST)
    return search.topk_ivf(spark, index, _label_queries(spark, d), 10, nprobe)


def vector_topk_ivf(spark, d):
    return _hits(_ivf(spark, d, TEST_NPROBE))


def vector_topk_ivf_all(spark, d):
    """Every cluster probed: the pruned search must then equal the exact one."""
    return _hits(_ivf(spark, d, TEST_NLIST))


# Clusters around given centres: the mean vector of each label. A query looks into 3 of them.
def _given_centres(spark: SparkSession, d: str) -> DataFrame:
    means = _label_queries(spark, d).orderBy("query_id").toPandas()["embedding"]
    index = search.build_ivf(_corpus(spark, d), scratch_path(spark, "ivf"), centers=np.array(means.tolist()))
    return search.topk_ivf(spark, index, _label_queries(spark, d), 10, 3)


def vector_topk_centres(spark, d):
    return _hits(_given_centres(spark, d))


def centres_recall(spark, d):
    return search.recall(_given_centres(spark, d), search.topk_exact(_corpus(spark, d), _label_queries(spark, d), 10))


def ivf_recall(spark, d):
    exact = search.topk_exact(_corpus(spark, d), _label_queries(spark, d), 10)
    return search.recall(_ivf(spark, d, TEST_NPROBE), exact)


# The learnt tree on the test vectors: leaves of 40 at most, and how many a query looks into.
TEST_CAPACITY, TEST_FANOUT, TEST_BEAM = 40, 4, 16


def _tree(spark: SparkSession, d: str) -> tree.ClusterTree:
    return tree.build_tree(_corpus(spark, d), scratch_path(spark, "tree"), TEST_CAPACITY, TEST_FANOUT)


def vector_tree_given(spark, d):
    """Two levels of given centres, the mean of each label and of its even and odd vectors; a query keeps 3 nodes a level."""
    corpus = _corpus(spark, d)
    node = (F.col("label") + 1).cast("long")
    labels = _mean_vectors(corpus, "label").select(F.lit(0).cast("long").alias("node"), node.alias("child"), F.col("embedding").alias("center"))
    half = corpus.withColumn("half", F.col("label") * 2 + F.pmod("id", F.lit(2)))
    halves = _mean_vectors(half, "half").select(
        (F.floor(F.col("half") / 2) + 1).cast("long").alias("node"), (F.col("half") + 100).cast("long").alias("child"), F.col("embedding").alias("center")
    )
    built = tree.build_tree(corpus, scratch_path(spark, "tree"), given=labels.unionByName(halves))
    return _hits(built.topk(_label_queries(spark, d), 10, 3))


def vector_tree_all(spark, d):
    """A learnt tree with every leaf read: equal to the exact search."""
    return _hits(_tree(spark, d).topk(_label_queries(spark, d), 10, 1 << 20))


def vector_tree_recall(spark, d):
    """Recall of a learnt tree, and the share of the vectors that a query is scored against."""
    built, asked = _tree(spark, d), _label_queries(spark, d)
    found = search.recall(built.topk(asked, 10, TEST_BEAM), search.topk_exact(_corpus(spark, d), asked, 10))
    return found.withColumn("share", built.share_read(asked, TEST_BEAM).scalar())


def _event_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Every event with its text and the text's vector, written once."""
    path = scratch_path(spark, "event_vectors")
    ev = ft.event_text(user_events(spark, d)).withColumnRenamed("event_no", "id").hint("rebalance")
    search.write_vectors(embed.embed_text(ev, "text_content"), path)
    return spark.read.parquet(path)


def _few(df: DataFrame) -> DataFrame:
    """A few question vectors, each a mean over the corpus: written once, as a search reads its queries several times."""
    path = scratch_path(df.sparkSession, "questions")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _page_queries(vectors: DataFrame) -> DataFrame:
    """One question per page, numbered by name: the mean vector of its events."""
    asked = _mean_vectors(vectors, "page")
    pages = vectors.agg(F.array_sort(F.collect_set("page")).alias("pages"))
    return _few(asked.crossJoin(pages).select(F.array_position("pages", F.col("page")).alias("query_id"), "embedding"))


def vector_search_events(spark, d):
    """Search among all purchase events by vectors of the events' texts, one question per page."""
    corpus = _event_vectors(spark, d)
    fields = {"event_id": "", "user_id": "", "event_type": "", "text_content": ""}
    hits = retrieval.search_rows(corpus, _page_queries(corpus), fields, 10, where=F.lower("event_type") == "purchase")
    return hits.select("query_id", "id", "score", "rank", *fields)


def vector_search_products(spark, d):
    """Search among all products; a product's vector is the mean over the vectors of all its events."""
    ev = _event_vectors(spark, d)
    vectors = _mean_vectors(ev.filter("product_id IS NOT NULL"), "product_id")
    corpus = vectors.join(_products(spark, d), "product_id").withColumn("id", F.substring("product_id", 2, 8).cast("long"))
    fields = {"product_id": "", "total_views": 0, "total_purchases": 0}
    hits = retrieval.search_rows(corpus, _page_queries(ev), fields, 5)
    return hits.select("query_id", "id", "score", "rank", *fields)


def _place(vector: str) -> Column:
    """Sum of the elements times their numbers."""
    return F.aggregate(F.transform(vector, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)


def text_embed(spark, d):
    """Vectors of all documents; ``place`` weighs each slot by its number, so that a wrong slot or weight shows."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = embed.embed_text(docs, "text", tasks=spark.sparkContext.defaultParallelism)
    return out.select(
        "doc_id", F.size("embedding").alias("dim"), F.round(fv.inner_product("embedding", "embedding"), 4).alias("norm"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("slots"), F.round(_place("embedding"), 3).alias("place"),
    )


def semantic_neighbours(spark, d):
    """The 5 documents nearest by latent semantic vectors to each document whose id 100 divides (itself included)."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").repartition(spark.sparkContext.defaultParallelism)
    vectors = semantic.apply_semantic(docs, "text", semantic.fit_semantic(docs, "text")).select("id", "embedding")
    path = scratch_path(spark, "semantic")
    vectors.write.parquet(path)
    corpus = spark.read.parquet(path)
    return _hits(search.topk_exact(corpus, corpus.filter("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding"), 5))


def vector_all_queries(spark, d):
    """Every vector asks the table it is in."""
    corpus = _corpus(spark, d)
    return _hits(search.topk_exact(corpus, corpus.select(F.col("id").alias("query_id"), "embedding"), 10))


# --- retrieval -------------------------------------------------------------------------------


def _whole_knowledge(spark: SparkSession, d: str) -> DataFrame:
    """The knowledge base of every event, with vectors of its own text; built once per query."""
    ev = clean.clean_events(user_events(spark, d, category=True), mode="clip")
    return retrieval.build_knowledge_base(ev, scratch_path(spark, "kb")).entries


def _questions(kb: DataFrame) -> DataFrame:
    """One question per event type, asked with the mean vector of that type."""
    ids = F.array_position(F.array(*[F.lit(t) for t in testtables.TEST_TYPES]), F.col("event_type"))
    asked = _mean_vectors(kb, "event_type").withColumn("query_id", ids)
    return _few(asked.select(
        "query_id", "embedding", F.col("event_type").alias("expected_type"), F.concat(F.lit("Find "), "event_type", F.lit(" events")).alias("question")
    ))


def rag_retrieve(spark, d):
    kb = _whole_knowledge(spark, d)
    return retrieval.retrieve(kb, _questions(kb), 5).select("query_id", "id", "score", "rank", "event_type", "user_id", "product_id", "chunk")


def rag_prompt(spark, d):
    kb = _whole_knowledge(spark, d)
    asked = _questions(kb)
    return retrieval.build_prompts(retrieval.retrieve(kb, asked, 5), asked.select("query_id", "question"))


def rag_hit_rate(spark, d):
    kb = _whole_knowledge(spark, d)
    asked = _questions(kb)
    return retrieval.hit_rate(retrieval.retrieve(kb, asked, 10), asked, 10)


def rag_first_types(spark, d):
    kb = _whole_knowledge(spark, d)
    return retrieval.first_types(retrieval.retrieve(kb, _questions(kb), 10))


def _intent_columns(out: DataFrame) -> DataFrame:
    entries = F.array_sort(F.map_entries("event_type_distribution"))
    return out.select(
        "query_id", "interpreted_intent", "distinct_users", "distinct_products", "suggested_sql",
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("distribution"),
        F.array_join(F.transform("top_matches", lambda m: F.concat(m["event_type"], F.lit("|"), m["text"])), ";").alias("matches"),
    )


def query_intent(spark, d):
    kb = _whole_knowledge(spark, d)
    return _intent_columns(retrieval.query_intent(retrieval.retrieve(kb, _questions(kb), 10)))


def kb_build_doubled(spark, d):
    """A knowledge base of events that all occur twice holds each once."""
    ev = user_events(spark, d, category=True)
    return retrieval.kb_rows(ev.unionByName(ev)).select("event_id", "event_type", "chunk")


def kb_build(spark, d):
    kb = retrieval.build_knowledge_base(user_events(spark, d, category=True), scratch_path(spark, "kb"))
    return kb.entries.select(
        "id", *retrieval.METADATA_COLUMNS, "product_category", "duration_ms", "chunk", F.size("embedding").alias("dim"),
        F.round(_place("embedding"), 3).alias("place"),
    )


# Text questions over the whole knowledge base and the event type each one is about.
TEXT_QUESTIONS = (
    (1, "User performed purchase from google via mobile Chrome", "purchase"),
    (2, "User performed click on page cart", "click"),
    (3, "User performed view on page product_detail via desktop", "view"),
    (4, "User performed signup from email", "signup"),
    (5, "User performed error on page profile via tablet", "error"),
)


def rag_text_hit_rate(spark, d):
    kb = retrieval.build_knowledge_base(user_events(spark, d, category=True), scratch_path(spark, "kb"))
    asked = spark.createDataFrame(TEXT_QUESTIONS, "query_id long, question string, expected_type string")
    hits = kb.ask(asked, 10).withColumn("event_type", F.lower("event_type"))
    return retrieval.hit_rate(hits, asked, 10)


def hit_metadata(spark, d):
    """Metadata from another table: hits on anything but a purchase have none and get defaults."""
    hits = search.topk_exact(_corpus(spark, d), _label_queries(spark, d), 10)
    bought = user_events(spark, d).filter(F.lower("event_type") == "purchase")
    meta = bought.select(F.col("event_no").alias("id"), "event_type", "user_id")
    return search.attach_metadata(hits, meta, {"event_type": "?", "user_id": "?"}).select("query_id", "id", "rank", "event_type", "user_id")


# --- streaming -------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream, shaped like user events."""
    schema = table(spark, d, "events").schema
    # A pattern, because a plain stream path must be a folder and the table may be one file.
    # No limit on files per micro-batch: the files are not in time order, so with several batches
    # the watermark of one would make the next one's rows late and drop them.
    source = sj.read_event_stream(spark, f"{d}/events.parque[t]", schema, fmt="parquet")
    return testtables.shape_events(source, missing_users=True)


def _finish(spark: SparkSession, sdf: DataFrame, label: str, fmt: str = "parquet") -> str:
    base = scratch_path(spark, label)
    sj.land_stream(sdf, f"{base}/out", f"{base}/checkpoint", fmt=fmt).awaitTermination()
    return f"{base}/out"


def stream_land(spark, d):
    path = _finish(spark, _event_stream(spark, d).select(*EVENT_COLUMNS), "land", fmt="json")
    return se.read_events_json(spark, path)


def stream_clean(spark, d):
    cleaned = sj.clean_stream(_event_stream(spark, d).select(*EVENT_COLUMNS), run_ts=_run_ts())
    return _edge(spark.read.parquet(_finish(spark, cleaned, "clean")).select(*CLEAN_COLUMNS, "processing_date"))


def stream_dedup(spark, d):
    ev = _event_stream(spark, d).select("event_id", "user_id", "event_ts")
    once = sj.dedup_stream(ev.unionByName(ev), "1 hour").select("event_id", "user_id")
    return spark.read.parquet(_finish(spark, once, "dedup"))


def _shaped(spark: SparkSession, d: str) -> DataFrame:
    return testtables.shape_events(table(spark, d, "events"), missing_users=True)


def _in_batches(spark: SparkSession, rows: DataFrame, label: str, files: int = 5) -> DataFrame:
    """The rows as a stream of one file per micro-batch, each with events of all times: most rows of a later file are late."""
    path = scratch_path(spark, label)
    rows.repartition(files).write.parquet(path)
    return sj.read_event_stream(spark, path, rows.schema, fmt="parquet", max_files=1)


def stream_dedup_batches(spark, d):
    """Every event twice, over five micro-batches that are out of order: each comes out once and none is lost."""
    ev = _shaped(spark, d).select("event_id", "user_id", "event_ts")
    base = scratch_path(spark, "arrivals")
    store = FirstArrivals(spark, f"{base}/store", ev.schema, buckets=8, pages=256)
    store.run(_in_batches(spark, ev.unionByName(ev), "arrivals-in"), f"{base}/checkpoint").awaitTermination()
    return store.rows().select("event_id", "user_id")


def stream_window_counts(spark, d):
    """Hourly counts of a live table that five micro-batches out of order have filled: every window, open ones too."""
    ev = _shaped(spark, d).select("event_ts", F.lower("event_type").alias("event_type"))
    base = scratch_path(spark, "windows")
    live = LiveWindows(spark, f"{base}/live", "1 hour")
    live.run(_in_batches(spark, ev, "windows-in"), f"{base}/checkpoint").awaitTermination()
    return _edge(live.counts().select("window_start", "events", "purchases"))


def stream_bounded(spark, d):
    """Events as stored records: one run that stops after 1,000 rows, and one that takes the rest in batches of 4,000."""
    ev = _shaped(spark, d).select(*EVENT_COLUMNS)
    no = F.col("key").cast("string").cast("long")
    place = {"partition": (no % 3).cast("int"), "offset": F.floor(no / 3).cast("long"), "timestamp": F.lit(None).cast("timestamp")}
    base = scratch_path(spark, "bounded")
    records.encode_records(ev).withColumns(place).select(*RECORD_SCHEMA.names).write.parquet(f"{base}/log")
    log = RecordLog(spark, f"{base}/log", f"{base}/out")
    log.consume(stop_after=1000)
    first = spark.createDataFrame(log.offsets.read().select("partition", F.col("next").alias("_next")).collect(), "partition int, _next long")
    log.consume(per_batch=4000)
    rows = log.rows.read().join(first, "partition", "left").withColumn("run", F.when(F.col("offset") < F.col("_next"), 1).otherwise(2))
    return rows.select("run", "offset", records.decoded().alias("e")).select("run", "offset", "e.event_id", "e.user_id", "e.event_type")


def stream_sliding_counts(spark, d):
    """The sliding-window counts of the live monitor, over the whole table as a batch."""
    return _edge(sj.window_counts(_folded(spark, d), "3 hours", "1 hour").select("window_start", "events", "purchases"))


def failure_rate_alert(spark, d):
    rates = alerts.failure_rate(_stg(spark, d), bad=("error",), good=("click", "view", "purchase", "signup"))
    return _edge(_rounded(alerts.rate_alert(rates, 0.3), "failure_rate").drop("window_end"))


def failure_rate_held(spark, d):
    """The failure-rate rule with its hold: above the limit for five minutes running."""
    rates = alerts.failure_rate(_stg(spark, d), bad=("error",), good=("click", "view", "purchase", "signup"))
    return _edge(alerts.rate_alert_held(rates, 0.3, 5))


def absence_alert(spark, d):
    return _edge(alerts.absence(user_events(spark, d), 600, where=F.lower("event_type") == "signup").select("window_start"))


def threshold_held(spark, d):
    hourly = sj.window_counts(user_events(spark, d), "1 hour", keys=("device",))
    return _edge(alerts.held_above(hourly, limit=2, hold=3, step_seconds=3600, keys=("device",)))


def request_rate(spark, d):
    return _edge(_rounded(alerts.request_rate(user_events(spark, d), 300, ("page",)), "per_second"))


# --- SQL surface and jobs --------------------------------------------------------------------


def _sql(spark: SparkSession, d: str, text: str) -> DataFrame:
    models.register_models(spark, user_events(spark, d), TEST_ROLES)
    return spark.sql(text)


def sample_sql_1(spark, d):
    return _sql(spark, d, "SELECT event_type, COUNT(*) AS cnt FROM raw_user_events GROUP BY event_type ORDER BY cnt DESC")


def sample_sql_2(spark, d):
    return _sql(spark, d, "SELECT user_segment, COUNT(*) AS users, SUM(total_events) AS events FROM dim_users GROUP BY user_segment")


def sample_sql_3(spark, d):
    return _sql(spark, d, "SELECT * FROM fct_user_events_daily ORDER BY event_date DESC, event_type LIMIT 10").withColumn(
        "event_date", F.col("event_date").cast("string")
    )


def sample_sql_4(spark, d):
    return _sql(spark, d, "SELECT * FROM dim_products ORDER BY conversion_rate_pct DESC NULLS LAST, product_id LIMIT 10")


def batch_job_counts(spark, d):
    """Files → clean Parquet → warehouse → models → checks: rows per table and failed rules."""
    base = scratch_path(spark, "job")
    se.write_events_json(raw_events(spark, d).select(*EVENT_COLUMNS), f"{base}/in")
    jobs.clean_files(spark, f"{base}/in", f"{base}/events", run_ts=_run_ts())
    names = jobs.Warehouse(base.rsplit("/", 1)[-1].replace("-", "_") + "_")
    warehouse.create_raw_table(spark, names.source, f"{base}/user_events")
    warehouse.load_warehouse(spark.read.parquet(f"{base}/events"), names.source, _run_ts())
    jobs.build_models(spark, f"{base}/models", names, TEST_ROLES)
    checks = jobs.check_models(spark, names)
    out = None
    for model, results in checks.items():
        at = {"user_events": names.source, "stg_user_events": names.staging}.get(model, names.clean(model))
        failed = results.agg(F.count_if(~F.col("passed")).alias("failed")).scalar()
        row = spark.table(at).agg(F.count("*").alias("rows")).select(F.lit(model).alias("model"), "rows", failed.alias("failed_rules"))
        out = row if out is None else out.unionByName(row)
    return out


def _refreshed(spark: SparkSession, d: str) -> DailyModels:
    """Models after a first build and a refresh: the last day, and late events of another, were staged in between."""
    base = scratch_path(spark, "refresh")
    stg = _stg(spark, d)
    first, last = stg.agg(F.min("event_date"), F.max("event_date")).first()
    late = (F.col("event_date") == F.lit(first)) & (F.pmod(F.col("event_id").cast("long"), F.lit(5)) == 0)
    new = late | (F.col("event_date") == F.lit(last))
    built = DailyModels(spark, f"{base}/models", TEST_ROLES)
    for part in (~new, new):
        arrived = stg.filter(part)
        arrived.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(f"{base}/stg")
        built.refresh(spark.read.parquet(f"{base}/stg"), [r[0] for r in arrived.select("event_date").distinct().collect()])
    return built


def refreshed_users(spark, d):
    return _refreshed(spark, d).dim_users()


def refreshed_products(spark, d):
    return _refreshed(spark, d).dim_products()


def refreshed_daily(spark, d):
    return _refreshed(spark, d).fct_user_events_daily()


# The names that these searches of every event had beside narrower ones.
vector_search_events_all, vector_search_products_all = vector_search_events, vector_search_products
rag_retrieve_all, rag_prompt_all, rag_hit_rate_all, rag_first_types_all = rag_retrieve, rag_prompt, rag_hit_rate, rag_first_types
query_intent_all = query_intent
WHOLE = ("vector_search_events", "vector_search_products", "rag_retrieve", "rag_prompt", "rag_hit_rate", "rag_first_types", "query_intent")

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_events, clip_duration, parse_timestamps, dedup_events, cleaning_report,
        read_jsonl_roundtrip, partitioned_roundtrip, recursive_read, glob_view, csv_roundtrip, warehouse_load, table_migration,
        table_append, incremental_read, high_water_mark, incremental_load, stored_mark, table_sample, table_head, source_availability, collection_stats,
        collection_report, cleaning_output, output_inspection, codec_sizes, layout_report, compaction_report, small_file_merge, kafka_roundtrip,
        stg_user_events, dim_users, dim_products, fct_user_events_daily,
        segment_totals, user_segments, events_by_type, top_products, top_users, top_users_page_2, product_rank, row_count,
        dashboard_overview, sales_trend, hourly_histogram, hourly_heatmap, daily_event_count,
        user_activity_rank, event_type_distribution, category_share, funnel, funnel_union, funnel_step_rates,
        filter_agg_device, agg_type_device, duration_stats,
        dq_not_null, dq_unique, dq_accepted_values, dq_ranges, dq_suite, dq_models, dq_summary, dq_failures, dq_stored_failures, dq_duplicates,
        user_features, user_features_fractional, product_features, feature_service_user, feature_service_product,
        feature_lookup, feature_latest, feature_online, feature_historical, feature_point_in_time, feature_point_in_time_ttl, feature_point_in_time_hot, recommendation_inputs,
        feature_summary, on_demand_udf, training_frame, training_split,
        segment_model_metrics, segment_model_report, rule_report, rule_metrics, segment_model_importance, segment_cv, segment_run_record,
        event_text, product_text, event_chunks, event_chunks_short, chunk_length_stats,
        vector_normalize, vector_topk_exact, vector_topk_dirty, vector_topk_filtered, vector_topk_ivf, vector_topk_ivf_all, ivf_recall, vector_topk_centres, centres_recall,
        vector_search_events, vector_search_products, vector_all_queries, vector_tree_given, vector_tree_all, vector_tree_recall, text_embed, semantic_neighbours,
        rag_retrieve, rag_prompt, rag_hit_rate, rag_first_types, query_intent,
        kb_build, kb_build_doubled, rag_text_hit_rate, hit_metadata,
        stream_land, stream_clean, stream_dedup, stream_dedup_batches, stream_window_counts, stream_bounded, stream_sliding_counts,
        failure_rate_alert, failure_rate_held, absence_alert, threshold_held, request_rate,
        sample_sql_1, sample_sql_2, sample_sql_3, sample_sql_4, batch_job_counts,
        refreshed_users, refreshed_products, refreshed_daily,
    )
}
QUERIES |= {f"{name}_all": QUERIES[name] for name in WHOLE}
