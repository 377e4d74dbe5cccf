"""Event schemas and vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The event layout and vocabularies every job agrees on.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("browser", T.StringType()),
    ]
)

# The warehouse source table: event columns plus category, parsed time and load metadata.
USER_EVENTS_DDL = """
    event_id STRING, user_id STRING, event_type STRING, product_id STRING,
    product_category STRING, timestamp STRING, event_ts TIMESTAMP, page STRING,
    referrer STRING, duration_ms DOUBLE, device STRING, browser STRING,
    processed_at TIMESTAMP, processing_date DATE
"""

# Key, value and log position columns of a record as a Kafka source delivers it.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

EVENT_TYPES = ("click", "view", "add_to_cart", "purchase", "search", "logout")
DEVICES = ("desktop", "mobile", "tablet")
# The forms that event times come in.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
)
MAX_DURATION_MS = 300_000
MISSING_PRODUCT = "unknown"
MISSING_REFERRER = "direct"


@dataclass(frozen=True)
class EventRoles:
    """Which event types play the browse, cart and buy steps."""

    browse: tuple[str, ...] = ("view", "search", "click")
    view: str = "view"
    cart: str = "add_to_cart"
    buy: str = "purchase"


DEFAULT_ROLES = EventRoles()
