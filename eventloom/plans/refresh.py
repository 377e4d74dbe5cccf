"""Modelled tables kept up to date by day: only days that changed are read again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom.functions.columns import tier
from eventloom.plans.models import SEGMENT_CUTS, SEGMENTS, fct_user_events_daily, product_counts, with_conversion
from eventloom.schema import DEFAULT_ROLES, EventRoles
from eventloom.streaming.live import BATCH, BatchTable

DAY = "event_date"


class DailyModels:
    """Partial states per day below ``path``, from which dimensions and the daily fact are put together.

    A day's state holds one row per user (events), per product (counts by role) and per event type (the fact itself).
    ``refresh`` replaces the states of the days it is given from all staged events of those days, so late and corrected
    events count as well, and a repeated refresh changes nothing. Dimensions add up the states of all days; events of other
    days are not read.

    Days to do are stored first and struck off last: after a run that broke off, the next one does its days again.
    A day that has no events any more is emptied. Events without a time belong to no day, as in the models.
    """

    def __init__(self, spark: SparkSession, path: str, roles: EventRoles = DEFAULT_ROLES, cuts: tuple[int, int, int] = SEGMENT_CUTS) -> None:
        self.spark, self.path, self.roles, self.cuts = spark, path, roles, cuts
        self.asked = BatchTable(spark, f"{path}/asked", f"{DAY} date")
        self.done = BatchTable(spark, f"{path}/done", "days long")

    def _last(self, table: BatchTable) -> int:
        last = table.batches().agg(F.max(BATCH)).first()[0]
        return -1 if last is None else last

    def pending(self) -> list[dt.date]:
        """Days asked for whose refresh has not come to its end."""
        rows = self.asked.batches().filter(F.col(BATCH) > self._last(self.done)).select(DAY).distinct()
        return sorted(r[DAY] for r in rows.collect())

    def _states(self, stg: DataFrame) -> dict[str, DataFrame]:
        return {
            "users": stg.groupBy(DAY, "user_id").agg(F.count("*").alias("total_events")),
            "products": product_counts(stg, self.roles, DAY),
            "daily": fct_user_events_daily(stg),
        }

    def refresh(self, stg: DataFrame, days: Sequence[dt.date] = ()) -> list[dt.date]:
        """Rebuild the states of ``days`` and of those still pending from the staged events; returns the days rebuilt.

        The filter on the day reaches the scan of ``stg``, where a table partitioned by day reads these days only.
        """
        number = self._last(self.asked) + 1
        if days:
            self.asked.put(self.spark.createDataFrame([(d,) for d in days], self.asked.schema), number)
        todo = self.pending()
        if not todo:
            return []
        frame = self.spark.createDataFrame([(d,) for d in todo], f"{DAY} date")
        for name, state in self._states(stg.filter(F.col(DAY).isin(todo))).items():
            # A row of nulls per day, so that a day without events is replaced, too.
            marked = state.withColumn("present", F.lit(True)).unionByName(frame, allowMissingColumns=True)
            (
                marked.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(DAY).parquet(f"{self.path}/{name}")
            )
        self.done.put(self.spark.createDataFrame([(len(todo),)], self.done.schema), self._last(self.asked))
        return todo

    def _read(self, name: str) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/{name}").filter("present").drop("present")
        return stored.withColumn(DAY, F.col(DAY).cast(T.DateType()))

    def dim_users(self) -> DataFrame:
        activity = self._read("users").groupBy("user_id").agg(
            F.min(DAY).alias("first_seen_at"), F.max(DAY).alias("last_seen_at"), F.sum("total_events").alias("total_events")
        )
        return activity.withColumn("user_segment", tier("total_events", self.cuts, SEGMENTS))

    def dim_products(self) -> DataFrame:
        counts = self._read("products").drop(DAY)
        return with_conversion(counts.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in counts.columns if c != "product_id"]))

    def fct_user_events_daily(self) -> DataFrame:
        daily = self._read("daily")
        return daily.select(DAY, *[c for c in daily.columns if c != DAY])
