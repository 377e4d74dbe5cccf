"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.session import scratch_path

# Fixed values of the data contract: rows whose crc32 of the id, modulo 4, is 2 are held out of every fit.
FOLDS, HELD_OUT = 4, 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **partitioning) -> DataFrame:
    """Write to the shared work folder and read back: cuts lineage, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, **partitioning)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def one_shuffle_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the shuffle files of a query when it ends: for steps that are stored one after the other."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def held_out(doc_id: str = "doc_id"):
    """True for rows that no fit may learn from. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def in_pieces(batches: Iterator[pa.RecordBatch], budget: int = 4_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``budget`` bytes of text; one long text may exceed it."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > budget:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
