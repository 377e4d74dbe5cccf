"""Dashboard statistics. Each is one scan with conditional aggregates; only groups are shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventloom.functions.columns import rate_pct
from eventloom.schema import DEFAULT_ROLES, EventRoles
from eventloom.session import bounded_broadcast

# Display names of the funnel steps, in order.
FUNNEL_STEPS = ("浏览/搜索", "加入购物车", "下单购买")

# Bins per group used to locate an exact rank: EDGE_GROUPS groups of EDGE_GROUPS, bounded by quantiles of the distinct
# values that a mergeable sketch of this accuracy gives.
EDGE_GROUPS, EDGE_ACCURACY = 16, 10_000


def _kind() -> Column:
    return F.col("event_type")


def share_of_total(df: DataFrame, col: str, digits: int, out: str = "pct") -> DataFrame:
    """Add ``col`` as % of its sum over all rows.

    For grouped frames only: the window spans all rows, of which there is one per group value.
    """
    total = F.sum(col).over(Window.partitionBy())
    return df.withColumn(out, rate_pct(F.col(col), total, digits))


# --- modelled tables -------------------------------------------------------------------------


def segment_totals(dim_users: DataFrame) -> DataFrame:
    return (
        dim_users.groupBy("user_segment")
        .agg(F.count("*").alias("cnt"), F.sum("total_events").alias("events"))
        .orderBy(F.desc("cnt"), "user_segment")
    )


def user_segments(dim_users: DataFrame) -> DataFrame:
    users = dim_users.groupBy(F.col("user_segment").alias("segment")).agg(
        F.count("*").alias("users"), F.sum("total_events").alias("events")
    )
    return share_of_total(users, "users", 1).orderBy(F.desc("users"), "segment")


def events_by_type(fct: DataFrame) -> DataFrame:
    return fct.groupBy("event_type").agg(F.sum("total_events").alias("cnt")).orderBy(F.desc("cnt"), "event_type")


def top_products(dim_products: DataFrame, n: int = 10, min_views: int = 5) -> DataFrame:
    return (
        dim_products.filter(F.col("total_views") > min_views)
        .select("product_id", "total_views", "total_purchases", "conversion_rate_pct")
        .orderBy(F.desc_nulls_last("conversion_rate_pct"), "product_id")
        .limit(n)
    )


def top_users(dim_users: DataFrame, n: int = 20, offset: int = 0) -> DataFrame:
    """Most active users; ``offset`` pages through the ranking."""
    return (
        dim_users.select(
            "user_id", F.col("user_segment").alias("segment"), "total_events",
            F.col("first_seen_at").alias("first_seen"), F.col("last_seen_at").alias("last_seen"),
        )
        .orderBy(F.desc("total_events"), "user_id")
        .offset(offset)
        .limit(n)
    )


def product_rank(dim_products: DataFrame, ev: DataFrame, n: int = 20) -> DataFrame:
    """Most viewed products with their category.

    Lazy at every size: the ranking is cut to ``n`` rows, and the events are reduced to its products by a semi join.
    """
    top = dim_products.select("product_id", "total_views", "total_purchases", "conversion_rate_pct").orderBy(
        F.desc("total_views"), "product_id"
    ).limit(n)
    wanted = ev.select("product_id", "product_category").join(bounded_broadcast(top.select("product_id"), n), "product_id", "left_semi")
    category = wanted.groupBy("product_id").agg(F.min("product_category").alias("category"))
    return (
        top.join(category, "product_id", "left")
        .select(
            "product_id",
            F.coalesce("category", F.lit("unknown")).alias("category"),
            "total_views",
            "total_purchases",
            F.round(F.col("conversion_rate_pct").cast("decimal(20,2)"), 1).cast("double").alias("conversion_rate"),
        )
        .orderBy(F.desc("total_views"), "product_id")
    )


# --- event table -----------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def overview(ev: DataFrame, roles: EventRoles = DEFAULT_ROLES) -> DataFrame:
    """Totals, purchases, distinct users and conversion in one pass; conversion is 0 without browsing."""
    browse = F.count_if(_kind().isin(*roles.browse))
    counts = ev.agg(
        F.count("*").alias("total_events"),
        F.count_if(_kind() == roles.buy).alias("today_orders"),
        F.count_distinct("user_id").alias("today_users"),
        browse.alias("_browse"),
    )
    rate = rate_pct(F.col("today_orders"), F.col("_browse"), 2)
    return counts.withColumn("conversion_rate", F.coalesce(rate, F.lit(0.0))).drop("_browse")


def _between_dates(ev: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Optional half-open range on ``event_ts``, as comparisons the scan can push down."""
    if start is not None:
        ev = ev.filter(F.col("event_ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        ev = ev.filter(F.col("event_ts") < F.lit(end).cast("timestamp"))
    return ev.filter(F.col("event_ts").isNotNull())


def trend(ev: DataFrame, start: str | None = None, end: str | None = None, roles: EventRoles = DEFAULT_ROLES) -> DataFrame:
    return (
        _between_dates(ev, start, end)
        .groupBy(F.to_date("event_ts").alias("date"))
        .agg(F.count("*").alias("events"), F.count_if(_kind() == roles.buy).alias("purchases"))
        .orderBy("date")
    )


def hourly(ev: DataFrame) -> DataFrame:
    known = ev.filter(F.col("event_ts").isNotNull())
    return known.groupBy(F.hour("event_ts").alias("hour")).agg(F.count("*").alias("events")).orderBy("hour")


def heatmap(ev: DataFrame) -> DataFrame:
    known = ev.filter(F.col("event_ts").isNotNull())
    return (
        known.groupBy(F.hour("event_ts").alias("hour"), "event_type")
        .agg(F.count("*").alias("cnt"))
        .orderBy("hour", "event_type")
    )


def daily_count(ev: DataFrame, date_col: str | Column = "processing_date", out: str = "processing_date") -> DataFrame:
    day = F.col(date_col) if isinstance(date_col, str) else date_col
    return ev.groupBy(day.alias(out)).agg(F.count("*").alias("cnt")).orderBy(out)


def activity_rank(ev: DataFrame, n: int = 10) -> DataFrame:
    return (
        ev.groupBy("user_id").agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "user_id").limit(n)
    )


def type_distribution(ev: DataFrame) -> DataFrame:
    counts = ev.groupBy("event_type").agg(F.count("*").alias("cnt"))
    return share_of_total(counts, "cnt", 2).orderBy(F.desc("cnt"), "event_type")


def category_share(ev: DataFrame, roles: EventRoles = DEFAULT_ROLES) -> DataFrame:
    counts = (
        ev.filter(F.col("product_category").isNotNull())
        .groupBy(F.col("product_category").alias("category"))
        .agg(F.count("*").alias("views"), F.count_if(_kind() == roles.buy).alias("purchases"))
    )
    return share_of_total(counts, "views", 1).orderBy(F.desc("views"), "category")


def funnel(ev: DataFrame, roles: EventRoles = DEFAULT_ROLES, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Browse, cart, buy: count and % of the first step, from one pass turned into three rows."""
    counts = ev.agg(
        F.count_if(_kind().isin(*roles.browse)).alias("s1"),
        F.count_if(_kind() == roles.cart).alias("s2"),
        F.count_if(_kind() == roles.buy).alias("s3"),
    )
    rows = F.stack(
        F.lit(3),
        F.lit(1), F.lit(steps[0]), F.col("s1"), F.lit(100.0),
        F.lit(2), F.lit(steps[1]), F.col("s2"), rate_pct(F.col("s2"), F.col("s1"), 1),
        F.lit(3), F.lit(steps[2]), F.col("s3"), rate_pct(F.col("s3"), F.col("s1"), 1),
    ).alias("step", "name", "value", "pct")
    return counts.select(rows).orderBy(F.desc("value"), "step")


def funnel_union(ev: DataFrame, roles: EventRoles = DEFAULT_ROLES, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """The step counts as a union of three filtered aggregates.

    Kept for callers whose steps come from different tables; on one table it scans three times.
    """
    parts = (_kind().isin(*roles.browse), _kind() == roles.cart, _kind() == roles.buy)
    out = None
    for i, (cond, name) in enumerate(zip(parts, steps), start=1):
        row = ev.filter(cond).agg(F.count("*").alias("value")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "value")
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc("value"), "step")


def step_rates(steps: DataFrame) -> DataFrame:
    """% of the first and of the previous step. Takes a funnel: one row per step."""
    w = Window.partitionBy().orderBy("step")
    return steps.select(
        "step", "name", "value",
        rate_pct(F.col("value"), F.first("value").over(w), 1).alias("pct_of_first"),
        rate_pct(F.col("value"), F.lag("value").over(w), 1).alias("pct_of_previous"),
    ).orderBy("step")


def filter_agg(df: DataFrame, pred: Column, key: str, value: str) -> DataFrame:
    return df.filter(pred).groupBy(key).agg(
        F.sum(value).alias(f"sum_{value}"), F.avg(value).alias(f"avg_{value}"), F.count("*").alias("cnt")
    )


def multi_key_agg(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(f"sum_{value}"), F.count("*").alias("cnt"))


# --- exact order statistics ------------------------------------------------------------------


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def _binned(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``n``, the group's rows, and ``b``, the bin of each distinct value ``v`` (with count ``c``).

    Bins lie between quantiles of the group's distinct values, so each holds about as many of them however far apart or
    frequent they are; the sketch only places the bins, whose rows are then counted exactly.
    """
    count = EDGE_GROUPS**2
    edges = F.percentile_approx("v", [i / count for i in range(1, count)], EDGE_ACCURACY)
    span = hist.groupBy(*keys).agg(edges.alias("_edges"), F.sum("c").alias("n"))
    # Every EDGE_GROUPS-th edge, picked once per group and not once per value.
    span = span.withColumn("_coarse", F.filter("_edges", lambda _, i: (i + 1) % EDGE_GROUPS == 0))
    if keys:
        spanned = hist.alias("h").join(span.alias("s"), _same_keys("h", "s", keys)).select("h.*", "_edges", "_coarse", "n")
    else:
        spanned = hist.withColumn("s", span.select(F.struct("_edges", "_coarse", "n")).scalar()).select("v", "c", "s.*")
    below = lambda some: F.size(F.filter(some, lambda e: e < F.col("v")))
    coarse = spanned.withColumn("_g", below(F.col("_coarse")) * EDGE_GROUPS)
    fine = F.col("_g") + below(F.slice("_edges", F.col("_g") + 1, F.lit(EDGE_GROUPS - 1)))
    return coarse.select(*keys, "v", "c", "n", fine.alias("b"))


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column]) -> DataFrame:
    """Exact sorted-position values per group: ``sorted(value)[rank]`` for each named rank.

    A rank is an expression over ``n``, the group's row count, e.g. ``F.floor(F.col("n") / 2)``.
    No group is gathered in one place. Rows collapse to (group, value, count) on the map side; 256 bins per group, placed
    by a quantile sketch, are cumulated to find the bin each rank falls in; only the values of those few bins are then
    ordered, bin by bin.
    """
    keys = list(keys)
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("v"))
        .agg(F.count("*").alias("c"))
    )
    binned = _binned(hist, keys)
    upto = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = (
        binned.groupBy(*keys, "b").agg(F.sum("c").alias("bc"), F.first("n").alias("n"))
        .withColumn("before", F.sum("bc").over(upto) - F.col("bc"))
    )
    inside = F.lit(False)
    for r in ranks.values():
        inside = inside | ((r >= F.col("before")) & (r < F.col("before") + F.col("bc")))
    target = bins.filter(inside).drop("bc", "n")
    within = Window.partitionBy(*keys, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        binned.alias("x")
        .join(target.alias("t"), _same_keys("x", "t", keys) & (F.col("x.b") == F.col("t.b")))
        .select(*[F.col(f"x.{k}").alias(k) for k in keys], "x.v", "x.c", "x.n", "x.b", "t.before")
        .withColumn("end", F.col("before") + F.sum("c").over(within))
    )
    hit = {name: (r < F.col("end")) & (r >= F.col("end") - F.col("c")) for name, r in ranks.items()}
    return placed.groupBy(*keys).agg(*[F.max(F.when(cond, F.col("v"))).alias(name) for name, cond in hit.items()])


def index_rank(p: float) -> Column:
    """Position ``int(n * p)`` of a sorted list; the only element when there is one."""
    n = F.col("n")
    return F.when(n > 1, F.floor(n * F.lit(p)).cast("long")).otherwise(F.lit(0).cast("long"))


def duration_stats(df: DataFrame, keys: Sequence[str] = ("event_type",), value: str = "duration_ms") -> DataFrame:
    """Count, mean, median, min, max, p95, p99 and sample deviation (0 for one row) per group."""
    keys = list(keys)
    n = F.col("n")
    ordered = order_statistics(
        df, keys, value,
        {
            "_mid_lo": F.floor((n - 1) / 2).cast("long"),
            "_mid_hi": F.floor(n / 2).cast("long"),
            "p95": index_rank(0.95),
            "p99": index_rank(0.99),
        },
    )
    simple = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.round(F.avg(value), 6).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 6).alias("stdev"),
    )
    return simple.alias("a").join(ordered.alias("o"), _same_keys("a", "o", keys)).select(
        *[F.col(f"a.{k}").alias(k) for k in keys],
        "count", "mean", ((F.col("_mid_lo") + F.col("_mid_hi")) / 2.0).cast("double").alias("median"),
        "min", "max", "p95", "p99", "stdev",
    )


def length_stats(df: DataFrame, col: str) -> DataFrame:
    """Shortest, longest, whole mean and upper median of text lengths."""
    sized = df.select(F.length(col).cast("long").alias("len"))
    ordered = order_statistics(sized, [], "len", {"median": F.floor(F.col("n") / 2).cast("long")})
    return sized.filter("len is not null").agg(
        F.count("len").alias("cnt"),
        F.min("len").alias("min"),
        F.max("len").alias("max"),
        F.floor(F.avg("len")).cast("long").alias("avg"),
    ).withColumn("median", ordered.scalar())
