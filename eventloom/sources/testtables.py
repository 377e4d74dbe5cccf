"""The synthetic test tables in the shape of user events.

The ``events`` table has an id, a time, a user number, a type, a value and a JSON property ``k``.
Product, device, page and the rest are derived from those by rule, so that null fills, case
folding, bad timestamps and both duration bounds all occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom.schema import EventRoles
from eventloom.session import use_utc

# The test events know no add_to_cart and no search: signup plays the cart step.
TEST_TYPES = ("click", "error", "purchase", "signup", "view")
TEST_ROLES = EventRoles(browse=("view", "click"), view="view", cart="signup", buy="purchase")

_USER = "concat('U', lpad(cast(user_id as string), 4, '0'))"
_SHAPE = {
    "event_id": "cast(event_id as string)",
    "user_id": _USER,
    "event_type": "case when event_id % 7 = 0 then upper(event_type) else event_type end",
    "product_id": "case when k < 70 then concat('P', lpad(cast(k as string), 4, '0')) end",
    "timestamp": """case event_id % 4
        when 0 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00')
        when 1 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00')
        when 2 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") else 'junk' end""",
    "page": """case event_id % 6 when 0 then 'home' when 1 then 'product_detail' when 2 then 'cart'
        when 3 then 'checkout' when 4 then 'profile' else 'search_results' end""",
    "referrer": """case event_id % 6 when 0 then 'google' when 1 then 'direct' when 2 then 'twitter'
        when 3 then 'facebook' when 4 then 'email' end""",
    "duration_ms": "cast(round((value - 5) * 1000) as bigint)",
    "device": "case event_id % 3 when 0 then 'desktop' when 1 then 'mobile' else 'tablet' end",
    "browser": """case event_id % 4 when 0 then 'Chrome' when 1 then 'Firefox'
        when 2 then 'Safari' else 'Edge' end""",
}


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is inferred once per session, which saves a job per query."""
    path = f"{sf_dir}/{name}.parquet"
    key = (use_utc(spark).sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def shape_events(events: DataFrame, missing_users: bool = False) -> DataFrame:
    """The event columns, plus ``event_ts`` and the numeric ``event_no``, ``k`` and ``value``."""
    exprs = dict(_SHAPE)
    if missing_users:
        exprs["user_id"] = f"case when event_id % 97 <> 0 then {_USER} end"
    base = events.selectExpr(
        "event_id", "user_id", "event_type", "ts", "value", "cast(get_json_object(props, '$.k') as int) as k"
    )
    return base.selectExpr(
        *[f"{e} as {c}" for c, e in exprs.items()], "cast(ts as timestamp) as event_ts", "event_id as event_no", "k", "value"
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive: text timestamps (some junk) and some missing users."""
    return shape_events(table(spark, sf_dir, "events"), missing_users=True).drop("event_ts", "event_no", "k", "value")


def user_events(spark: SparkSession, sf_dir: str, category: bool = False) -> DataFrame:
    """Events as the warehouse holds them: every user and time known.

    ``category`` joins the product's category from ``part``, which costs a second scan.
    """
    ev = shape_events(table(spark, sf_dir, "events"))
    if category:
        part = table(spark, sf_dir, "part").selectExpr("cast(p_partkey as int) as k", "p_type")
        named = F.when(F.col("k") < 70, F.col("p_type")).alias("product_category")
        ev = ev.join(part, "k", "left").select(*ev.columns, named)
    return ev
