"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Above this many rows a side is never hinted for broadcast, whatever the caller claims.
BROADCAST_ROW_LIMIT = 10_000

_local_work_dirs: dict[str, str] = {}


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and per-partition overwrite.

    Leave ``master`` unset under spark-submit. Parallelism is left to the cluster: AQE
    coalesces small shuffle partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin session time to UTC; event times carry no zone of their own."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``, or the context's own.

    Only a local session may fall back to a fresh temporary folder; on a cluster the
    executors would not see it, so there an unset folder is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_work_dirs:
        _local_work_dirs[context.applicationId] = tempfile.mkdtemp(prefix="eventloom-")
    return _local_work_dirs[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared work folder."""
    return os.path.join(work_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side that cannot hold more than ``rows`` rows.

    ``rows`` must be a bound by construction (a LIMIT, a literal list). Past the row limit
    the frame is returned unhinted and Catalyst and AQE choose the join.
    """
    return df.hint("broadcast") if rows <= BROADCAST_ROW_LIMIT else df
