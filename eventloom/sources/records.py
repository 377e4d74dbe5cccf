"""Events as log records: the key/value frames a Kafka source reads and a Kafka sink writes.

Both are plain transforms, so the same code serves ``format("kafka")`` where that connector is
installed and any frame of the same schema where it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventloom.schema import EVENT_SCHEMA


def encode_records(df: DataFrame, key: str = "event_id", topic: str = "events") -> DataFrame:
    """One JSON record per row: ``key``, ``value``, ``topic``."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def decoded(schema: T.StructType = EVENT_SCHEMA) -> Column:
    """The event in the ``value`` bytes."""
    return F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})


def decode_records(records: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Events from the ``value`` bytes; an undecodable record becomes an all-null row."""
    return records.select(decoded(schema).alias("e")).select("e.*")
