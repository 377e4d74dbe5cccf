"""Event cleaning. Every transform is row-wise, so batch and streaming frames share it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.columns import clip, lenient_ts, parse_event_ts
from eventloom.schema import MAX_DURATION_MS, MISSING_PRODUCT, MISSING_REFERRER

# A cleaned row is compared with this many bytes of raw JSON in the report.
RAW_BYTES_PER_ROW = 512


def has_keys() -> Column:
    return F.col("event_id").isNotNull() & F.col("user_id").isNotNull()


def duration_ok(min_ms: int = 0, max_ms: int = MAX_DURATION_MS) -> Column:
    """Missing durations are kept; present ones must lie in the range."""
    return F.col("duration_ms").isNull() | F.col("duration_ms").between(min_ms, max_ms)


def clean_events(
    df: DataFrame,
    min_ms: int = 0,
    max_ms: int = MAX_DURATION_MS,
    mode: str = "filter",
    run_ts: Column | None = None,
) -> DataFrame:
    """Drop rows without keys, parse time, fold case, fill defaults, bound the duration.

    ``mode="filter"`` drops rows whose duration is out of range; ``mode="clip"`` limits the
    value and keeps the row. ``run_ts`` fixes the load time (default: now).
    """
    if mode not in ("filter", "clip"):
        raise ValueError(f"unknown mode {mode!r}")
    stamp = F.current_timestamp() if run_ts is None else run_ts.cast("timestamp")
    kept = df.filter(has_keys())
    if mode == "filter":
        kept = kept.filter(duration_ok(min_ms, max_ms))
    changed = {
        "event_ts": parse_event_ts("timestamp"),
        "event_type": F.lower("event_type"),
        "product_id": F.coalesce("product_id", F.lit(MISSING_PRODUCT)),
        "referrer": F.coalesce("referrer", F.lit(MISSING_REFERRER)),
        "processed_at": stamp,
        "processing_date": F.to_date(stamp),
    }
    if mode == "clip":
        changed["duration_ms"] = clip("duration_ms", min_ms, max_ms)
    return kept.withColumns(changed)


def dedup(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("event_ts",)) -> DataFrame:
    """Keep the first row per key in ``order``.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so a key
    with very many copies reaches its reducer as one row per map task.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Concatenate by column name; a column missing on one side becomes null there."""
    out = first
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def cleaning_report(
    raw: DataFrame,
    date_col: Column,
    min_ms: int = 0,
    max_ms: int = MAX_DURATION_MS,
) -> DataFrame:
    """Row counts of each cleaning step and the partitions a load would write, in one scan."""
    keyed, fit = has_keys(), duration_ok(min_ms, max_ms)
    kept = keyed & fit
    combo = F.when(kept, F.struct(date_col.alias("d"), F.lower("event_type").alias("t")))
    counts = raw.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(~keyed).alias("dropped_null_key"),
        F.count_if(keyed & ~fit).alias("dropped_duration"),
        F.count_if(kept).alias("clean_rows"),
        F.count_distinct(combo).alias("partitions"),
    )
    return counts.select(
        "*",
        (F.col("raw_rows") - F.col("clean_rows")).alias("dropped_rows"),
        F.round(F.col("clean_rows") * 100.0 / F.nullif(F.col("raw_rows"), F.lit(0)), 1).cast("double").alias("retention_pct"),
        (F.col("clean_rows") * RAW_BYTES_PER_ROW / (1024.0 * 1024.0)).cast("double").alias("raw_estimate_mb"),
    )


def warehouse_rows(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Rows as the warehouse source table holds them: time coerced, defaults filled, one per id."""
    stamp = F.current_timestamp() if run_ts is None else run_ts.cast("timestamp")
    shaped = df.withColumns(
        {
            "event_ts": lenient_ts("timestamp"),
            "product_id": F.coalesce("product_id", F.lit(MISSING_PRODUCT)),
            "referrer": F.coalesce("referrer", F.lit(MISSING_REFERRER)),
            "duration_ms": F.col("duration_ms").cast("double"),
            "processed_at": stamp,
            "processing_date": F.to_date(stamp),
        }
    )
    if "product_category" not in df.columns:
        shaped = shaped.withColumn("product_category", F.lit(None).cast("string"))
    return dedup(shaped, "event_id", ("event_ts", "timestamp", "user_id"))
