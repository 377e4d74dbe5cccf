"""Declarative data-quality rules.

All row-level rules of a suite are one aggregation over one scan. A unique rule needs a shuffle on the checked column;
the first one of a suite carries the counters of all other rules along, so a suite with one is one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.schema import DEVICES, EVENT_TYPES

ROW_RULES = ("not_null", "accepted_values")
RANGE_RULES = ("min_between", "max_between", "row_count_between")


@dataclass(frozen=True)
class Rule:
    """One check. ``kind`` is a row rule, a range rule, ``unique`` or ``ordered_columns``."""

    kind: str
    column: str = ""
    values: tuple[str, ...] = field(default=())
    low: float | None = None
    high: float | None = None
    severity: str = "error"

    def __post_init__(self) -> None:
        if self.kind not in (*ROW_RULES, *RANGE_RULES, "unique", "ordered_columns"):
            raise ValueError(f"unknown rule kind {self.kind!r}")

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


# Column order, value sets and ranges the user-event suite expects.
USER_EVENT_COLUMNS = (
    "event_id", "user_id", "event_type", "product_id", "timestamp", "event_ts", "page",
    "referrer", "duration_ms", "device", "browser", "processed_at", "processing_date",
)
USER_EVENT_SUITE = (
    Rule("ordered_columns", values=USER_EVENT_COLUMNS),
    Rule("not_null", "event_id"),
    Rule("not_null", "user_id"),
    Rule("not_null", "event_type"),
    Rule("unique", "event_id"),
    Rule("accepted_values", "event_type", EVENT_TYPES),
    Rule("accepted_values", "device", DEVICES),
    Rule("min_between", "duration_ms", low=0, high=100),
    Rule("max_between", "duration_ms", low=0, high=300_000),
    Rule("row_count_between", low=1, high=1_000_000),
)

# Rules declared per model: source, staging view, dimensions, daily fact.
MODEL_RULES = {
    "user_events": (
        Rule("not_null", "event_id"),
        Rule("unique", "event_id"),
        Rule("not_null", "user_id"),
        Rule("not_null", "event_type"),
        Rule("accepted_values", "event_type", EVENT_TYPES),
    ),
    "stg_user_events": (
        Rule("not_null", "event_id"),
        Rule("unique", "event_id"),
        Rule("not_null", "user_id"),
        Rule("not_null", "event_type"),
    ),
    "dim_users": (Rule("not_null", "user_id"), Rule("unique", "user_id")),
    "fct_user_events_daily": (Rule("not_null", "event_date"), Rule("not_null", "event_type")),
    "dim_products": (Rule("not_null", "product_id"), Rule("unique", "product_id")),
}


def violates(rule: Rule) -> Column:
    """Rows that break a row-level rule. A null passes an accepted-values check."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return F.coalesce(~c.isin(*rule.values), F.lit(False))
    raise ValueError(f"{rule.kind} is not a row-level rule")


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` found on more than one row, with their row counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n_records")).filter("n_records > 1")
    )


def _in_range(c: Column, rule: Rule) -> Column:
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (c >= rule.low)
    if rule.high is not None:
        ok = ok & (c <= rule.high)
    return F.coalesce(ok, F.lit(False))


def _measure(rule: Rule) -> Column:
    """What a row or range rule needs of some rows: failing rows, an extreme or the number of rows."""
    if rule.kind in ROW_RULES:
        return F.count_if(violates(rule))
    return {
        "min_between": lambda: F.min(rule.column),
        "max_between": lambda: F.max(rule.column),
        "row_count_between": lambda: F.count("*"),
    }[rule.kind]()


def _together(rule: Rule, part: str) -> Column:
    """The measure of all rows from those of some rows each."""
    if rule.kind in ("min_between", "max_between"):
        return F.min(part) if rule.kind == "min_between" else F.max(part)
    return F.coalesce(F.sum(part), F.lit(0))


def _failures(rule: Rule, measure: Column) -> Column:
    """Failure count from the measure: rows for row rules, 0 or 1 for range rules."""
    if rule.kind in ROW_RULES:
        return measure
    return F.when(_in_range(measure, rule), F.lit(0)).otherwise(F.lit(1)).cast("long")


def _result(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column"),
        failures.cast("long").alias("failures"),
        (failures == 0).alias("passed"),
        F.when(failures == 0, F.lit("pass")).otherwise(F.lit(rule.severity)).alias("status"),
    )


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, column, failures, passed, status. Never raises on a failed rule."""
    passes = []
    scanned = [r for r in rules if r.kind in (*ROW_RULES, *RANGE_RULES)]
    listed = [r for r in rules if r.kind == "ordered_columns"]
    unique = [r for r in rules if r.kind == "unique"]
    names = {r: f"f{i}" for i, r in enumerate(scanned)}
    rows = [_result(r, _failures(r, F.col(n))) for r, n in names.items()]
    # Column order is known from the schema; it needs no data.
    rows += [_result(r, F.lit(int(tuple(df.columns) != r.values))) for r in listed]
    if unique:
        first, *unique = unique
        by_key = df.groupBy(F.col(first.column).alias("_key")).agg(F.count("*").alias("_n"), *[_measure(r).alias(n) for r, n in names.items()])
        repeated = F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull())
        counted = by_key.agg(repeated.alias("_repeated"), *[_together(r, n).alias(n) for r, n in names.items()])
        passes.append(counted.select(F.inline(F.array(*rows, _result(first, F.col("_repeated"))))))
    elif rows:
        counted = df.agg(*[_measure(r).alias(n) for r, n in names.items()] or [F.lit(0).alias("f")])
        passes.append(counted.select(F.inline(F.array(*rows))))
    for r in unique:
        failing = duplicate_keys(df, r.column).agg(F.count("*").alias("f"))
        passes.append(failing.select(F.inline(F.array(_result(r, F.col("f"))))))
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out


def suite_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("rules"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warnings"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows behind a failure: violating rows, or the duplicated values of a unique rule."""
    if rule.kind == "unique":
        return duplicate_keys(df, rule.column)
    return df.filter(violates(rule))


def failing_values(df: DataFrame, rules: Sequence[Rule], key: str = "event_id") -> DataFrame:
    """Every violation of the row-level rules as (rule, key, value), found in a single scan."""
    rows = [
        F.when(violates(r), F.struct(F.lit(r.name).alias("rule"), F.col(r.column).cast("string").alias("value")))
        for r in rules if r.kind in ROW_RULES
    ]
    hits = df.select(F.col(key), F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("hit"))
    return hits.select("hit.rule", F.col(key), "hit.value")


def store_failures(df: DataFrame, rules: Sequence[Rule], path: str, key: str = "event_id") -> None:
    """Write the violations below ``path``, one folder per rule."""
    failing_values(df, rules, key).write.mode("overwrite").partitionBy("rule").parquet(f"{path}/rows")
    for r in rules:
        if r.kind == "unique":
            duplicate_keys(df, r.column).write.mode("overwrite").parquet(f"{path}/unique_{r.column}")
