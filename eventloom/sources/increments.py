"""Incremental loads by a stored high-water mark: a run that breaks off is made again and not skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventloom.streaming.live import BATCH, BatchTable


class IncrementalLoad:
    """Copies rows newer than the last mark into a table below ``path``, one increment at a time.

    An increment first writes what it is about to load (an intent: the times after ``low`` up to ``high``), then the rows
    under its number, then a commit with the mark it has reached. Without a commit nothing of it is read, and the next run
    loads the same times again in its place. So every row arrives once, whenever a run is lost.

    Times decide what is new: rows that come to the source later with a time at or below the mark are not seen, nor are
    rows without a time. The row count and the newest time come from one scan of the new rows; the comparison with the
    mark reaches the source's scan.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str = "event_ts") -> None:
        self.spark, self.ts = spark, ts
        kind = schema[ts].dataType.simpleString()
        self.loaded = BatchTable(spark, f"{path}/rows", schema)
        self.intents = BatchTable(spark, f"{path}/intents", f"low {kind}, high {kind}")
        self.commits = BatchTable(spark, f"{path}/commits", f"mark {kind}, rows long")

    def _done(self) -> tuple[int, object]:
        """Number of the last increment that was committed (-1 if none) and the mark."""
        row = self.commits.batches().agg(F.max(BATCH).alias("n"), F.max("mark").alias("mark")).first()
        return (-1, None) if row["n"] is None else (row["n"], row["mark"])

    def mark(self) -> DataFrame:
        """One row: ``mark`` (null before the first increment), ``increments`` and ``rows``."""
        return self.commits.read().agg(F.max("mark").alias("mark"), F.count(F.lit(1)).alias("increments"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))

    def run(self, source: DataFrame) -> int:
        """Load what is newer than the mark; returns the number of rows, 0 if there is nothing new."""
        last, mark = self._done()
        number = last + 1
        begun = self.intents.batch(number).first()
        low, high = (mark, None) if begun is None else (begun["low"], begun["high"])
        new = source if low is None else source.filter(F.col(self.ts) > F.lit(low))
        if high is None:
            high = new.agg(F.max(self.ts)).first()[0]
            if high is None:
                return 0
            self.intents.put(self.spark.createDataFrame([(low, high)], self.intents.schema), number)
        self.loaded.put(new.filter(F.col(self.ts) <= F.lit(high)), number)
        rows = self.loaded.batch(number).count()
        self.commits.put(self.spark.createDataFrame([(high, rows)], self.commits.schema), number)
        return rows

    def rows(self) -> DataFrame:
        """All rows of committed increments."""
        return self.loaded.read(before=self._done()[0] + 1)
