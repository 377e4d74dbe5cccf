"""Batch jobs: event files to clean Parquet, and the build of the modelled warehouse."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from eventloom.operators.clean import clean_events, dedup
from eventloom.operators.quality import MODEL_RULES, run_suite
from eventloom.plans.models import SEGMENT_CUTS, dim_products, dim_users, fct_user_events_daily, stg_user_events
from eventloom.schema import DEFAULT_ROLES, EventRoles
from eventloom.sources.events import read_events_json, write_events
from eventloom.sources.layout import check_output


def clean_files(spark: SparkSession, src: str, dst: str, run_ts: Column | None = None) -> int:
    """JSON lines → clean, one row per event id → partitioned Parquet. Returns rows written.

    An input without rows is an error and writes nothing; so is an empty output.
    """
    raw = read_events_json(spark, src)
    if raw.isEmpty():
        raise ValueError(f"no events at {src}")
    rows = write_events(dedup(clean_events(raw, run_ts=run_ts), "event_id", ("event_ts", "user_id")), dst)
    check_output(spark, dst)
    return rows


@dataclass(frozen=True)
class Warehouse:
    """Names of the catalog objects. ``prefix`` keeps several builds apart in one catalog."""

    prefix: str = ""

    @property
    def source(self) -> str:
        return f"{self.prefix}raw.user_events"

    @property
    def staging(self) -> str:
        return f"{self.prefix}public_raw.stg_user_events"

    def clean(self, model: str) -> str:
        return f"{self.prefix}public_clean.{model}"


def publish(df: DataFrame, table: str, base: str) -> None:
    """Replace a table's contents without a moment in which it is missing or half written.

    Each build writes a new folder, then the catalog entry is pointed at it.
    """
    spark = df.sparkSession
    folder = f"{base}/{table}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}'")


def build_models(
    spark: SparkSession,
    base: str,
    names: Warehouse = Warehouse(),
    roles: EventRoles = DEFAULT_ROLES,
    cuts: tuple[int, int, int] = SEGMENT_CUTS,
) -> None:
    """Source table → staging → dimensions and fact, in dependency order. Each is written once, below ``base``."""
    for database in {names.staging.split(".")[0], names.clean("x").split(".")[0]}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}/{database}.db'")
    publish(stg_user_events(spark.table(names.source)), names.staging, base)
    stg = spark.table(names.staging)
    publish(dim_users(stg, cuts), names.clean("dim_users"), base)
    publish(dim_products(stg, roles), names.clean("dim_products"), base)
    publish(fct_user_events_daily(stg), names.clean("fct_user_events_daily"), base)


def check_models(spark: SparkSession, names: Warehouse = Warehouse()) -> dict[str, DataFrame]:
    """Rule results per model."""
    tables = {"user_events": names.source, "stg_user_events": names.staging}
    return {
        model: run_suite(spark.table(tables.get(model, names.clean(model))), rules)
        for model, rules in MODEL_RULES.items()
    }
