"""Continuous jobs: landing, cleaning, deduplication and windowed counts of an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.clean import clean_events
from eventloom.schema import EVENT_SCHEMA


def read_event_stream(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Files below ``path`` as a stream. ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def land_stream(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = True,
    fmt: str = "json",
    by: Sequence[str] = (),
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append the stream to files, each input row exactly once across restarts.

    The sink's file log and the checkpoint together make a repeated micro-batch a no-op. With
    ``once`` the job stops when it has caught up with what was there at the start, in as many
    micro-batches as the source's limits ask for.
    """
    writer = sdf.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start(path)


def clean_stream(sdf: DataFrame, run_ts: Column | None = None, **options: object) -> DataFrame:
    """The batch cleaning, which is row-wise, applied to a stream."""
    return clean_events(sdf, run_ts=run_ts, **options)


def dedup_stream(sdf: DataFrame, delay: str = "1 hour", key: str = "event_id", ts: str = "event_ts") -> DataFrame:
    """First arrival per key. State for a key is dropped once the watermark is ``delay`` past it."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def window_counts(
    df: DataFrame,
    size: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    ts: str = "event_ts",
    watermark: str | None = None,
    buy: str = "purchase",
) -> DataFrame:
    """Events and purchases per time window (and key); batch and stream alike.

    A sliding window is built from tumbling counts one ``slide`` long, so an event is counted
    once and not once per overlapping window. ``size`` must be a multiple of ``slide``.
    """
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    counted = df.groupBy(F.window(ts, slide or size).alias("window"), *keys).agg(
        F.count("*").alias("events"), F.count_if(F.col("event_type") == buy).alias("purchases")
    )
    if slide is not None and slide != size:
        counted = counted.groupBy(F.window("window", size, slide).alias("window"), *keys).agg(
            F.sum("events").alias("events"), F.sum("purchases").alias("purchases")
        )
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "events", "purchases")
