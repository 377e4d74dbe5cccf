"""Modelled tables: staging view, user and product dimensions, daily fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom.functions.columns import rate_pct, tier
from eventloom.schema import DEFAULT_ROLES, EventRoles, MISSING_PRODUCT, MISSING_REFERRER

# Segment names from most to least active and their event thresholds.
SEGMENTS = ("power_user", "active", "regular", "new")
SEGMENT_CUTS = (50, 10, 2)


def stg_user_events(raw: DataFrame) -> DataFrame:
    """Events with a known time, case folded and defaults filled."""
    passed = [c for c in ("processed_at", "processing_date") if c in raw.columns]
    return raw.filter(F.col("event_ts").isNotNull()).select(
        "event_id",
        "user_id",
        F.lower("event_type").alias("event_type"),
        F.coalesce("product_id", F.lit(MISSING_PRODUCT)).alias("product_id"),
        "event_ts",
        F.to_date("event_ts").alias("event_date"),
        "page",
        F.coalesce("referrer", F.lit(MISSING_REFERRER)).alias("referrer"),
        "duration_ms",
        "device",
        "browser",
        *passed,
    )


def dim_users(stg: DataFrame, cuts: tuple[int, int, int] = SEGMENT_CUTS) -> DataFrame:
    activity = stg.groupBy("user_id").agg(
        F.min("event_date").alias("first_seen_at"),
        F.max("event_date").alias("last_seen_at"),
        F.count("*").alias("total_events"),
    )
    return activity.withColumn("user_segment", tier("total_events", cuts, SEGMENTS))


def product_counts(stg: DataFrame, roles: EventRoles = DEFAULT_ROLES, *by: str) -> DataFrame:
    """Events of each known product (and ``by``), by role."""
    kind = F.col("event_type")
    return stg.filter(F.col("product_id") != MISSING_PRODUCT).groupBy("product_id", *by).agg(
        F.count_if(kind == roles.view).alias("total_views"),
        F.count_if(kind == roles.buy).alias("total_purchases"),
        F.count_if(kind == roles.cart).alias("total_add_to_cart"),
        F.count("*").alias("total_interactions"),
    )


def with_conversion(counts: DataFrame) -> DataFrame:
    """Conversion is 0 without purchases and null without views."""
    rate = F.when(F.col("total_purchases") > 0, rate_pct(F.col("total_purchases"), F.col("total_views"), 2))
    return counts.withColumn("conversion_rate_pct", rate.otherwise(F.lit(0.0)))


def dim_products(stg: DataFrame, roles: EventRoles = DEFAULT_ROLES) -> DataFrame:
    return with_conversion(product_counts(stg, roles))


def fct_user_events_daily(stg: DataFrame) -> DataFrame:
    """Per day and type, over events with a duration.

    Distinct users are first reduced per (day, type, user) on the map side, so a hot day or type
    shuffles one row per user and task, spread by user.
    """
    # Whole milliseconds are summed as longs; decimals come in only on the grouped rows.
    whole = isinstance(stg.schema["duration_ms"].dataType, T.IntegralType)
    ms = F.col("duration_ms") if whole else F.col("duration_ms").cast("decimal(18,3)")
    total = F.col("_ms").cast("decimal(28,3)")
    grouped = stg.filter(F.col("duration_ms").isNotNull()).groupBy("event_date", "event_type").agg(
        F.count("*").alias("total_events"), F.count_distinct("user_id").alias("unique_users"), F.sum(ms).alias("_ms")
    )
    return grouped.select(
        "event_date", "event_type", "total_events", "unique_users",
        F.round(total / F.col("total_events"), 0).cast("long").alias("avg_duration_ms"),
        F.round(total / 1000, 2).cast("double").alias("total_duration_seconds"),
    )


def register_models(spark: SparkSession, ev: DataFrame, roles: EventRoles = DEFAULT_ROLES) -> None:
    """Name the source and all models as temporary views for read-only SQL."""
    stg = stg_user_events(ev)
    views = {
        "raw_user_events": ev,
        "stg_user_events": stg,
        "dim_users": dim_users(stg),
        "dim_products": dim_products(stg, roles),
        "fct_user_events_daily": fct_user_events_daily(stg),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
