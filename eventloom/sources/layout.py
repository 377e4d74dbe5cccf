"""Storage layout: what a folder holds, partition strategies, codecs and compaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators.clean import RAW_BYTES_PER_ROW
from eventloom.sources.events import write_events

# The partition strategies compared, from least to most data per day.
LAYOUTS: Mapping[str, tuple[str, ...]] = {
    "date": ("event_date",),
    "date_type": ("event_date", "event_type"),
    "date_hour": ("event_date", "event_hour"),
}
CODECS = ("snappy", "gzip", "zstd", "lz4")


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Path and length of the data files below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )


def inspect_output(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """File count, bytes, megabytes and whether the output is usable."""
    totals = list_files(spark, path, pattern).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
    return totals.select(
        "files", "bytes", F.round(F.col("bytes") / (1024.0 * 1024.0), 2).alias("megabytes"),
        ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("usable"),
    )


def written_report(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """What a load of ``rows`` cleaned rows has written: files, size, and size in % of the rows as JSON lines (estimated).

    The ratio is null where no rows were written.
    """
    estimate = rows * RAW_BYTES_PER_ROW
    return inspect_output(spark, path).select(
        F.lit(rows).cast("long").alias("clean_rows"), "files", "bytes", "megabytes", F.lit(estimate / (1024.0 * 1024.0)).alias("raw_estimate_mb"),
        F.round(F.col("bytes") * 100.0 / F.nullif(F.lit(estimate), F.lit(0)), 1).cast("double").alias("compression_pct"), "usable",
    )


def check_output(spark: SparkSession, path: str) -> None:
    """Raise when the output is missing or empty."""
    row = inspect_output(spark, path).first()
    if not row["usable"]:
        raise ValueError(f"no output at {path}")


def _labelled_inspection(spark: SparkSession, paths: Mapping[str, str], label: str) -> DataFrame:
    out = None
    for name, path in paths.items():
        row = inspect_output(spark, path).select(F.lit(name).alias(label), "files", "bytes", "usable")
        out = row if out is None else out.unionByName(row)
    return out


def layout_report(df: DataFrame, base: str, layouts: Mapping[str, Sequence[str]] = LAYOUTS) -> DataFrame:
    """Write the frame under each partition strategy and report its files and bytes.

    ``df`` needs ``event_ts`` and ``event_type``; date and hour columns are added here.
    """
    keyed = df.withColumn("event_date", F.to_date("event_ts")).withColumn("event_hour", F.hour("event_ts"))
    paths = {}
    for name, by in layouts.items():
        paths[name] = f"{base}/{name}"
        write_events(keyed, paths[name], by=by, replace="all")
    return _labelled_inspection(df.sparkSession, paths, "layout")


def codec_sizes(df: DataFrame, base: str, codecs: Sequence[str] = CODECS) -> DataFrame:
    """Write the frame under each compression codec and report its files and bytes."""
    paths = {}
    for codec in codecs:
        paths[codec] = f"{base}/{codec}"
        df.write.mode("overwrite").option("compression", codec).parquet(paths[codec])
    return _labelled_inspection(df.sparkSession, paths, "codec")


def compact(spark: SparkSession, src: str, dst: str, files: int | None = None, by: Sequence[str] = (), shuffle: bool = False) -> None:
    """Rewrite many small files as fewer larger ones.

    With ``files`` the count is exact: merged without a shuffle, or evenly with ``shuffle``. With
    ``by`` rows gather by partition column. With neither, AQE sizes the files by its advisory
    partition size, the choice that needs no knowledge of the data volume.
    """
    df = spark.read.parquet(src)
    if files is not None:
        df = df.repartition(files) if shuffle else df.coalesce(files)
    elif by:
        df = df.hint("rebalance", *by)
    else:
        df = df.hint("rebalance")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(dst)


def compaction_report(spark: SparkSession, before: str, after: str) -> DataFrame:
    return _labelled_inspection(spark, {"before": before, "after": after}, "stage")
