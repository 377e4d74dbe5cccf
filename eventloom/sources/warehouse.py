"""Catalog tables: create, load, migrate, append, read incrementally, inspect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from eventloom.operators.clean import warehouse_rows
from eventloom.schema import USER_EVENTS_DDL


def _in_folder(path: str | None) -> str:
    return f"LOCATION '{path}'" if path else ""


def _create_database(spark: SparkSession, table: str, path: str | None) -> None:
    """The table's database, beside the table's own folder if it has one."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]} {_in_folder(path and path + '.db')}")


def create_raw_table(spark: SparkSession, table: str = "raw.user_events", path: str | None = None) -> None:
    """Create the database and the source table unless they exist."""
    _create_database(spark, table, path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({USER_EVENTS_DDL}) USING parquet {_in_folder(path)}")


def load_warehouse(df: DataFrame, table: str = "raw.user_events", run_ts: Column | None = None) -> int:
    """Replace the table by the deduplicated, filled rows of ``df``; returns rows written.

    ``insertInto`` matches by position, so the table's own column order is selected first.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = warehouse_rows(df, run_ts).select(*spark.table(table).columns)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=True)
    return seen.get["rows"]


def read_table(spark: SparkSession, table: str, limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """A table, or its first ``limit`` rows in ``order``."""
    df = spark.table(table)
    if order:
        df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def read_jdbc(spark: SparkSession, url: str, table: str, limit: int | None = None, **options: str) -> DataFrame:
    """A live database table; the limit is pushed down to it.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a
    large table over several connections instead of one.
    """
    df = spark.read.format("jdbc").options(url=url, dbtable=table, pushDownLimit="true", **options).load()
    return df if limit is None else df.limit(limit)


def migrate_table(
    df: DataFrame,
    table: str,
    by: Sequence[str] = ("processing_date", "event_type"),
    path: str | None = None,
    fmt: str = "parquet",
) -> int:
    """Create a partitioned catalog table with the frame's columns and insert its rows."""
    spark = df.sparkSession
    plain = [f for f in df.schema.fields if f.name not in by]
    ordered = plain + [df.schema[c] for c in by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    parts = ", ".join(f"`{c}`" for c in by)
    _create_database(spark, table, path)
    partitioned = f"PARTITIONED BY ({parts})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} {partitioned} {_in_folder(path)}")
    return append_rows(df, table, by)


def append_rows(df: DataFrame, table: str, by: Sequence[str] = ()) -> int:
    """Append to an existing table by column name; returns rows written."""
    seen = Observation()
    out = df.select(*df.sparkSession.table(table).columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    if by:
        out = out.hint("rebalance", *by)
    out.write.insertInto(table)
    return seen.get["rows"]


def read_since(df: DataFrame, ts_col: str, mark: Column) -> DataFrame:
    """Rows newer than the last mark; the comparison reaches the scan as a pushed filter."""
    return df.filter(F.col(ts_col) > mark)


def high_water_mark(df: DataFrame, ts_col: str) -> DataFrame:
    return df.agg(F.max(ts_col).alias("mark"))


def availability(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> DataFrame:
    """Row count and availability per table. Tables are counted now; whatever stops a read is reported as its error."""
    if not tables:
        raise ValueError("no tables given")
    rows = []
    for name, source in tables.items():
        try:
            count = (spark.table(source) if isinstance(source, str) else source).count()
            rows.append((name, count, count > 0, None))
        except Exception as error:  # a report of what cannot be read, whatever the reason
            rows.append((name, 0, False, str(error).strip().splitlines()[0]))
    return spark.createDataFrame(rows, "table_name string, row_count long, available boolean, error string")


def table_schema(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Column names and types of a table."""
    df = spark.table(source) if isinstance(source, str) else source
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")
