"""Event files: JSON lines in, partitioned Parquet out, and readers for both."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from eventloom.schema import EVENT_SCHEMA


def read_events_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = EVENT_SCHEMA,
    corrupt_column: str | None = None,
) -> DataFrame:
    """JSON lines under a fixed schema; a value that does not fit becomes null.

    A malformed line is an all-null row, which cleaning drops for its missing keys. Name a
    ``corrupt_column`` to keep the raw text of such lines instead of losing it.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).json(path)


def write_events_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_events(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("processing_date", "event_type"),
    codec: str = "snappy",
    rebalance: bool = True,
    replace: str = "partitions",
) -> int:
    """Write partitioned Parquet and return the row count.

    ``replace="partitions"`` overwrites only the partitions present in ``df``; ``"all"`` replaces
    the whole output and commits faster when there are many partitions.

    The count is observed during the write, so the input is read once. ``rebalance`` groups rows
    by output partition before writing; AQE cuts large partitions into several even files and
    merges small ones, so neither one hot event type nor many tasks decide the file sizes.
    """
    if replace not in ("partitions", "all"):
        raise ValueError(f"unknown replace {replace!r}")
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if rebalance and by:
        out = out.hint("rebalance", *by)
    (
        out.write.mode("overwrite")
        .option("compression", codec)
        .option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
        .partitionBy(*by)
        .parquet(path)
    )
    return seen.get["rows"]


def read_parquet_tree(
    spark: SparkSession,
    path: str | list[str],
    nan_to_null: bool = True,
    missing_words: Sequence[str] = (),
    merge_schema: bool = True,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Every Parquet file below ``path`` as one table.

    Schemas are merged (which reads every footer; switch it off for many files of one schema), column names are
    lower-cased and NaN becomes null. Folder names are not read as partition columns. An unreadable file is an error;
    with ``skip_corrupt`` such files are left out, and ``unreadable_files`` lists them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("mergeSchema", merge_schema)
        .option("ignoreCorruptFiles", skip_corrupt)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )
    columns = []
    for f in df.schema.fields:
        c: Column = F.col(f"`{f.name}`")
        if nan_to_null and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if missing_words and isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(*missing_words), c)
        columns.append(c.alias(f.name.lower()))
    return df.select(*columns)


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of every Parquet file below a folder that holds no Parquet data: its first and last 4 bytes tell.

    Only these bytes are read, by Arrow on the executors, so the folder must be one that Arrow opens (local, HDFS, S3, GCS).
    Files of no bytes at all are passed over, by the readers as well.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)

    def bad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name, uri, length in zip(*(c.to_pylist() for c in batch.columns)):
                if length >= 12:
                    # Spark leaves letters beyond ASCII as they are, Arrow wants them encoded.
                    system, inside = fs.FileSystem.from_uri(quote(uri, safe="%/:?#[]@!$&'()*+,;=~"))
                    with system.open_input_file(inside) as f:
                        if f.read_at(4, 0) == f.read_at(4, length - 4) == b"PAR1":
                            continue
                found.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])

    return files.select("path", F.col("_metadata.file_path").alias("uri"), "length").mapInArrow(bad, "path string")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def glob_view(spark: SparkSession, pattern: str, name: str) -> DataFrame:
    """Name every Parquet file matching a glob for SQL."""
    return register_view(spark.read.parquet(pattern), name)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, chosen by a seeded hash of the key: the same rows on every run.

    The plan is a top-n per task and one merge of those, not a full sort.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(order, key).limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, every value quoted, null as the empty string."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    (
        text.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read back what ``write_csv`` wrote; every column is text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
