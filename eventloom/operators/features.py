"""User and product features, feature views, services and point-in-time joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from eventloom.functions.columns import clip, days_since, tier
from eventloom.session import BROADCAST_ROW_LIMIT, bounded_broadcast, scratch_path

# Popularity tiers and the view counts that reach them.
TIERS = ("hot", "warm", "cool", "cold")
TIER_CUTS = (100, 50, 10)
MAX_SCORE = 100.0


@dataclass(frozen=True)
class FeatureView:
    """Features of one entity: a source frame, its key, event time, columns and lifetime."""

    name: str
    source: DataFrame
    entity: str
    columns: tuple[str, ...]
    ts: str | None = None
    ttl_seconds: int | None = None
    tags: dict[str, str] = field(default_factory=dict)

    def frame(self) -> DataFrame:
        keep = [self.entity, *([self.ts] if self.ts and self.ts not in self.columns else []), *self.columns]
        return self.source.select(*keep)


@dataclass(frozen=True)
class FeatureService:
    """A named selection of columns from several views of the same entity."""

    name: str
    views: tuple[tuple[FeatureView, tuple[str, ...]], ...]
    tags: dict[str, str] = field(default_factory=dict)


def activity_score(events: Column, days_since_last: Column) -> Column:
    """Events per day since the last one, limited to 0–100; an unknown last day counts as 1."""
    return clip(events / (F.coalesce(days_since_last, F.lit(1)) + 1), 0.0, MAX_SCORE)


def lookup(df: DataFrame, key: str, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the given entities, by a semi join with their ids."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key), key, "left_semi")
    listed = df.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([df.schema[key]]))
    return df.join(listed, key, "left_semi")


def user_features(
    dim_users: DataFrame,
    as_of: Column,
    ids: Sequence[str] | DataFrame | None = None,
    whole_days: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Segment, totals, days since first and last activity, activity score.

    ``whole_days`` truncates the days before scoring, else fractions are used.
    """
    days = lookup(dim_users, "user_id", ids).select(
        "user_id", "user_segment", "total_events", "first_seen_at", "last_seen_at",
        days_since("first_seen_at", as_of, whole_days).alias("days_since_first_seen"),
        days_since("last_seen_at", as_of, whole_days).alias("days_since_last_seen"),
    )
    scored = days.withColumn("activity_score", activity_score(F.col("total_events"), F.col("days_since_last_seen")))
    if limit is None:
        return scored
    return scored.orderBy(F.desc("total_events"), "user_id").limit(limit)


def product_features(
    dim_products: DataFrame, ids: Sequence[str] | DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Counts, conversion, popularity tier and smoothed purchase/view ratio."""
    ratio = F.col("total_purchases") / (F.col("total_views") + 1)
    out = lookup(dim_products, "product_id", ids).select(
        "product_id", "total_views", "total_purchases", "conversion_rate_pct",
        tier("total_views", TIER_CUTS, TIERS).alias("popularity_tier"),
        F.round(ratio, 4).alias("purchase_view_ratio"),
    )
    if limit is None:
        return out
    return out.orderBy(F.desc("total_views"), "product_id").limit(limit)


def on_demand(
    df: DataFrame, transform: Callable[[pd.DataFrame], pd.DataFrame], inputs: Sequence[str], schema: T.StructType | str
) -> DataFrame:
    """Add columns computed by a user's vectorised pandas function, batch by Arrow batch.

    Built-in features above are column expressions; this is the way in for user code.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    derived = F.pandas_udf(lambda pdf: transform(pdf)[schema.names], returnType=schema)
    columns = [F.col(c) for c in inputs]
    with_out = df.withColumn("_derived", derived(F.struct(*columns)))
    return with_out.select(*df.columns, "_derived.*")


def service(entities: DataFrame, svc: FeatureService) -> DataFrame:
    """Entity frame left-joined with the chosen columns of each view on the entity key."""
    out = entities
    for view, columns in svc.views:
        out = out.join(view.source.select(view.entity, *columns), view.entity, "left")
    return out


def latest(view: FeatureView, tie: Sequence[str] = ()) -> DataFrame:
    """Newest feature row per entity. The maximum is taken on the map side first."""
    if view.ts is None:
        raise ValueError(f"{view.name} has no event time")
    rest = [c for c in view.columns if c != view.ts and c not in tie]
    row = F.max(F.struct(F.col(view.ts), *[F.col(c) for c in tie], *[F.col(c) for c in rest])).alias("_r")
    newest = view.source.filter(F.col(view.ts).isNotNull()).groupBy(view.entity).agg(row)
    return newest.select(view.entity, F.col(f"_r.{view.ts}"), *[F.col(f"_r.{c}") for c in view.columns if c != view.ts])


def materialize(view: FeatureView, path: str, tie: Sequence[str] = ()) -> None:
    """Write the newest row per entity, sorted by entity within files for lookups."""
    latest(view, tie).sortWithinPartitions(view.entity).write.mode("overwrite").parquet(path)


def point_in_time(
    spine: DataFrame,
    view: FeatureView,
    as_of: str,
    tie: Sequence[str] = (),
    bucket_seconds: int = 3600,
) -> DataFrame:
    """For each spine row, the view's newest row at or before ``as_of`` (within its lifetime).

    No (spine row, feature row) pairs are formed. Both sides are laid on one time line per entity
    and the last feature seen is carried forward. The line is cut into time buckets so that a hot
    entity is spread over many tasks:

    1. the last feature of each (entity, bucket) is found by a map-side maximum;
    2. those, at most one row per entity and bucket, are carried to the later buckets;
    3. each spine row takes the last feature inside its own bucket, else the carried one.
    """
    if view.ts is None:
        raise ValueError(f"{view.name} has no event time")
    entity, ts = view.entity, view.ts
    fields = [F.col(ts).alias("_fts"), *[F.col(c) for c in tie], *[F.col(c) for c in view.columns if c not in tie]]

    def bucket(c: str) -> Column:
        return F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / bucket_seconds)

    facts = view.source.filter(F.col(ts).isNotNull() & F.col(entity).isNotNull()).select(
        F.col(entity).alias("_e"), bucket(ts).alias("_b"), F.struct(*fields).alias("_f")
    )
    # Spine rows without a key or a time match nothing: they stay out of the shuffles and come back with null features.
    known = F.col(entity).isNotNull() & F.col(as_of).isNotNull()
    asked = spine.filter(known).select(
        F.col(entity).alias("_e"), bucket(as_of).alias("_b"), F.col(as_of).alias("_t"), F.struct("*").alias("_s")
    )
    closing = facts.groupBy("_e", "_b").agg(F.max("_f").alias("_last"))
    opened = asked.select("_e", "_b").distinct().withColumn("_last", F.lit(None).cast(closing.schema["_last"].dataType))
    line = closing.unionByName(opened).groupBy("_e", "_b").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy("_e").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.select("_e", "_b", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))

    none_f = F.lit(None).cast(facts.schema["_f"].dataType)
    none_s = F.lit(None).cast(asked.schema["_s"].dataType)
    both = (
        facts.select("_e", "_b", F.col("_f._fts").alias("_t"), F.lit(0).alias("_k"), "_f", none_s.alias("_s"))
        .unionByName(asked.select("_e", "_b", "_t", F.lit(1).alias("_k"), none_f.alias("_f"), "_s"))
        .unionByName(
            carried.filter("_carry is not null").select(
                "_e", "_b", F.lit(None).cast(asked.schema["_t"].dataType).alias("_t"),
                F.lit(0).alias("_k"), F.col("_carry").alias("_f"), none_s.alias("_s"),
            )
        )
    )
    # A carried row has no time and sorts first; at equal times features precede the question.
    upto = (
        Window.partitionBy("_e", "_b")
        .orderBy(F.col("_t").asc_nulls_first(), "_k", F.col("_f").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_hit", F.last("_f", ignorenulls=True).over(upto)).filter("_k = 1")
    return _with_hits(found, spine, view, ~known)


def _with_hits(found: DataFrame, spine: DataFrame, view: FeatureView, unasked: Column) -> DataFrame:
    """Spine columns and those of the feature row ``_hit``, if it is young enough; ``unasked`` spine rows get nulls."""
    usable = F.lit(True)
    if view.ttl_seconds is not None:
        age = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col("_hit._fts").cast("timestamp"))
        usable = usable & (age <= view.ttl_seconds * 1_000_000)
    hit = F.when(usable, F.col("_hit"))
    spine_columns = [F.col(f"_s.{c}").alias(c) for c in spine.columns]
    taken = [hit.getField("_fts").alias(f"{view.name}_ts")]
    taken += [hit.getField(c).alias(f"{view.name}_{c}" if c in spine.columns else c) for c in view.columns]
    out = found.select(*spine_columns, *taken)
    features = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields[len(spine_columns) :]]
    return out.unionByName(spine.filter(unasked).select(*spine.columns, *features))


def point_in_time_pieces(spine: DataFrame, view: FeatureView, as_of: str, tie: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """``point_in_time`` for entities that may have most of their rows within one hour, or all rows to one entity.

    The time lines of all entities are laid one behind the other and cut into ``pieces`` of about equal row counts
    (16 per shuffle partition by default, 10,000 at most), wherever that falls; a piece is then scanned alone:

    1. features and questions are range-partitioned by entity and time, and **written** with the number of their piece,
       so that every later step (and a repeated one) sees the same cuts;
    2. the last feature of each piece is carried to the pieces behind it, one row per piece;
    3. a question takes the last feature before it in its piece, else the carried one if that is its entity's.

    Same result as ``point_in_time``. It sorts by sampled ranges and stores both sides once, which only pays where time
    buckets do not split the load. Questions without a key or a time come back with null features.
    """
    if view.ts is None:
        raise ValueError(f"{view.name} has no event time")
    spark, entity, ts = spine.sparkSession, view.entity, view.ts
    pieces = pieces or min(BROADCAST_ROW_LIMIT, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = [F.col(ts).alias("_fts"), *[F.col(c) for c in tie], *[F.col(c) for c in view.columns if c not in tie]]
    known = F.col(entity).isNotNull() & F.col(as_of).isNotNull()
    facts = view.source.filter(F.col(ts).isNotNull() & F.col(entity).isNotNull()).select(
        F.col(entity).alias("_e"), F.col(ts).alias("_t"), F.lit(0).alias("_k"), F.struct(*fields).alias("_f")
    )
    asked = spine.filter(known).select(F.col(entity).alias("_e"), F.col(as_of).alias("_t"), F.lit(1).alias("_k"), F.struct("*").alias("_s"))
    # Questions of one moment are told apart by a hash, so that even they can be cut.
    line = facts.unionByName(asked, allowMissingColumns=True).withColumn("_r", F.xxhash64("_s"))
    path = scratch_path(spark, "pieces")
    line.repartitionByRange(pieces, "_e", "_t", "_k", "_f", "_r").withColumn("_p", F.spark_partition_id()).write.parquet(path)
    laid = spark.read.parquet(path)

    last = laid.filter("_k = 0").groupBy("_p").agg(F.max(F.struct("_e", "_f")).alias("_last"))
    # At most one row per piece.
    numbers = spark.range(pieces).select(F.col("id").cast("int").alias("_p")).join(last, "_p", "left")
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.select("_p", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    upto = (
        Window.partitionBy("_p", "_e")
        .orderBy("_t", "_k", F.col("_f").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = laid.withColumn("_own", F.last("_f", ignorenulls=True).over(upto)).filter("_k = 1")
    found = within.join(bounded_broadcast(carried, pieces), "_p", "left").withColumn(
        "_hit", F.coalesce("_own", F.when(F.col("_carry._e") == F.col("_e"), F.col("_carry._f")))
    )
    return _with_hits(found, spine, view, ~known)


def historical(spine: DataFrame, views: Sequence[FeatureView], as_of: str, ties: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Point-in-time join of several views onto one spine. ``ties`` names, by view, the columns that decide between equal times."""
    out = spine
    for view in views:
        out = point_in_time(out, view, as_of, (ties or {}).get(view.name, ()))
    return out


def recommendation_inputs(users: DataFrame, products: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """The ``n`` most active users and the ``n`` best converting hot or warm products."""
    top_users = users.select("user_id", "user_segment", "activity_score").orderBy(
        F.desc_nulls_last("activity_score"), "user_id"
    ).limit(n)
    top_products = (
        products.filter(F.col("popularity_tier").isin("hot", "warm"))
        .select("product_id", "popularity_tier", "conversion_rate_pct", "purchase_view_ratio")
        .orderBy(F.desc_nulls_last("purchase_view_ratio"), "product_id").limit(n)
    )
    return top_users, top_products


def feature_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows and mean value per group."""
    return df.groupBy(group).agg(F.count("*").alias("cnt"), F.round(F.avg(value), 6).alias(f"mean_{value}"))
