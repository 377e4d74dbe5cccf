"""Stream results kept in tables that any arrival order fills completely.

A micro-batch adds its own rows under its batch id and replaces them when it is repeated, so a restart counts nothing
twice. Nothing is dropped for being late: there is no watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.streaming.jobs import window_counts

BATCH, MERGED = "batch_id", "through"


def folders(spark: SparkSession, path: str, by: str) -> list[tuple[int, str]]:
    """The folders ``by=N`` below ``path`` in order of N."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(root)]
    return sorted((int(n.removeprefix(f"{by}=")), f"{path}/{n}") for n in names if n.startswith(f"{by}="))


class BatchTable:
    """Rows by micro-batch below ``path``: ``rows/batch_id=N``, and ``merged/through=N`` for all batches up to N.

    ``commits`` has a line for each merge that is complete; a merge that broke off is not read and is made again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, by: Sequence[str] = ()) -> None:
        self.spark, self.path, self.by = spark, path, tuple(by)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        empty = spark.createDataFrame([], self.schema)
        for folder, whole in (("rows", BATCH), ("merged", MERGED)):
            # Without rows only the folder is made; one that holds rows stays as it is.
            empty.withColumn(whole, F.lit(0).cast("long")).write.mode("append").partitionBy(whole, *self.by).parquet(f"{path}/{folder}")
        spark.createDataFrame([], f"{MERGED} long").write.mode("append").parquet(f"{path}/commits")

    def _read(self, folder: str, by: str) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(by, T.LongType())])).parquet(f"{self.path}/{folder}")

    def _replace(self, rows: DataFrame, folder: str) -> None:
        # A static overwrite of the folder is also right when there are no rows this time.
        writer = rows.select(*self.schema.names).write.option("partitionOverwriteMode", "static").mode("overwrite")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/{folder}")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of one micro-batch, in place of those an earlier try has left."""
        self._replace(rows, f"rows/{BATCH}={batch_id}")

    def take(self, folder: str, batch_id: int) -> None:
        """As ``put``, of rows that stand in a folder of files; it is moved."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        target = path(f"{self.path}/rows/{BATCH}={batch_id}")
        fs = target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        fs.delete(target, True)
        if not fs.rename(path(folder), target):
            raise OSError(f"{folder} cannot be moved to {target}")

    def batch(self, batch_id: int) -> DataFrame:
        return self._read("rows", BATCH).filter(F.col(BATCH) == batch_id).drop(BATCH)

    def batches(self) -> DataFrame:
        """Unmerged rows with their ``batch_id``."""
        return self._read("rows", BATCH)

    def merged_through(self) -> int:
        done = self.spark.read.schema(f"{MERGED} long").parquet(f"{self.path}/commits").agg(F.max(MERGED)).first()[0]
        return -1 if done is None else done

    def read(self, before: int | None = None) -> DataFrame:
        """All rows, or those of batches before one. Merged rows are read in place of the batches they came from."""
        done = self.merged_through()
        new = self._read("rows", BATCH).filter(F.col(BATCH) > done)
        if before is not None:
            new = new.filter(F.col(BATCH) < before)
        old = self._read("merged", MERGED).filter(F.col(MERGED) == done)
        return old.drop(MERGED).unionByName(new.drop(BATCH))

    def merge(self, through: int, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Replace batches up to ``through`` by what ``combine`` makes of their rows.

        Not while the query that fills the table runs, and only for batches that are complete.
        """
        if through <= self.merged_through():
            return
        self._replace(combine(self.read(through + 1)).hint("rebalance"), f"merged/{MERGED}={through}")
        self.spark.createDataFrame([(through,)], f"{MERGED} long").write.mode("append").parquet(f"{self.path}/commits")


class LiveWindows:
    """Counts per time window (and key) that are complete whatever order events arrive in.

    The table holds partial counts of the smallest windows, one row per batch, window and key; reading adds them up, and
    sliding windows are sums of those. Its size grows with windows and batches, not with events; ``merge`` folds
    finished batches into one row per window.
    """

    def __init__(self, spark: SparkSession, path: str, size: str, slide: str | None = None, keys: Sequence[str] = (), ts: str = "event_ts", buy: str = "purchase") -> None:
        self.size, self.slide, self.keys, self.ts, self.buy = size, slide or size, tuple(keys), ts, buy
        fields = [("window_start", "timestamp"), *((k, "string") for k in keys), ("events", "long"), ("purchases", "long")]
        self.table = BatchTable(spark, path, ", ".join(f"`{n}` {t}" for n, t in fields))

    def _add(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", *self.keys).agg(F.sum("events").alias("events"), F.sum("purchases").alias("purchases"))

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Put the partial counts of one micro-batch; the function that ``foreachBatch`` calls. Events without a time count nowhere."""
        self.table.put(window_counts(batch, self.slide, None, self.keys, self.ts, buy=self.buy), batch_id)

    def counts(self) -> DataFrame:
        """``window_start, window_end``, keys, ``events`` and ``purchases`` of every window with an event so far."""
        parts = self._add(self.table.read())
        if self.slide != self.size:
            over = parts.groupBy(F.window("window_start", self.size, self.slide).alias("window"), *self.keys)
            parts = over.agg(F.sum("events").alias("events"), F.sum("purchases").alias("purchases")).withColumn("window_start", F.col("window.start"))
        end = F.col("window_start") + F.expr(f"interval {self.size}")
        return parts.select("window_start", end.alias("window_end"), *self.keys, "events", "purchases")

    def merge(self, through: int) -> None:
        self.table.merge(through, self._add)

    def run(self, sdf: DataFrame, checkpoint: str, once: bool = True, interval: str = "1 minute") -> StreamingQuery:
        """Fill the table from a stream; with ``once`` until it has caught up with what was there at the start."""
        return start(sdf, self.update, checkpoint, once, interval)


def start(sdf: DataFrame, update: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, interval: str = "1 minute") -> StreamingQuery:
    writer = sdf.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


# --- first arrivals ------------------------------------------------------------------------------

# Bits of a page as the bitmap functions have it.
PAGE_BITS = 1 << 15


class FirstArrivals:
    """One row per key of a stream, over any number of micro-batches and restarts.

    Keys that were seen are kept on disk, dealt by hash into ``buckets`` folders. A micro-batch asks bit pages first (one
    bit per key hash, ``pages`` pages of 32,768 bits): a key whose bit is not set is new, and only the others are looked
    up, in their own buckets.

    ``ttl`` bounds the store: a row whose time is older than the newest of earlier batches by more than this is late. Late
    rows go to a table of their own, whether or not their key is known, and are counted; ``merge`` forgets keys that
    old, because copies of a row carry its time and can only come late. Without ``ttl`` nothing is late and the store
    grows with the keys.

    Within a batch the row with the smallest time (null first) and then the smallest values stays. Rows without a key
    all stay.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str = "event_id", ts: str = "event_ts",
        ttl: str | None = None, buckets: int = 64, pages: int = 4096,
    ) -> None:
        self.spark, self.key, self.ts, self.ttl, self.buckets, self.pages = spark, key, ts, ttl, buckets, pages
        self.first, self.late = BatchTable(spark, f"{path}/first", schema), BatchTable(spark, f"{path}/late", schema)
        self.staged = BatchTable(spark, f"{path}/staged", T.StructType([*schema.fields, T.StructField("_kind", T.StringType())]))
        self.marks = BatchTable(spark, f"{path}/marks", f"newest {schema[ts].dataType.simpleString()}, arrived long, late long")
        self.bits = BatchTable(spark, f"{path}/bits", "page int, bits binary")
        self.seen = BatchTable(spark, f"{path}/seen", T.StructType([schema[key], schema[ts], T.StructField("bucket", T.IntegerType())]), by=("bucket",))

    def horizon(self, batch_id: int | None = None) -> Column:
        """Rows older than this are late; null if nothing is."""
        if self.ttl is None:
            return F.lit(None).cast("timestamp")
        return F.lit(self.marks.read(batch_id).agg(F.max("newest")).first()[0]).cast("timestamp") - F.expr(f"interval {self.ttl}")

    def _hashed(self, rows: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64(self.key), F.lit(self.pages * PAGE_BITS))
        bucket = F.pmod(F.xxhash64(F.lit(1), self.key), F.lit(self.buckets)).cast("int")
        return rows.withColumns({"bucket": bucket, "_page": F.floor(slot / PAGE_BITS).cast("int"), "_bit": (slot % PAGE_BITS).cast("int")})

    def _known(self, keys: DataFrame, batch_id: int) -> DataFrame | None:
        """Which of these keys an earlier batch has had; None if none can be."""
        pages = self.bits.read(batch_id).groupBy(F.col("page").alias("_page")).agg(F.bitmap_or_agg("bits").alias("_bits"))
        byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        maybe = keys.join(pages, "_page").filter(F.getbit(byte, F.col("_bit") % 8) == 1).select(self.key, "bucket")
        buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]
        if not buckets:
            return None
        return self.seen.read(batch_id).filter(F.col("bucket").isin(buckets)).join(maybe, ["bucket", self.key], "left_semi").select(self.key)

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch; the function that ``foreachBatch`` calls. A repeated batch replaces its own rows."""
        columns = self.first.schema.names
        kind = F.when(F.col(self.ts) < self.horizon(batch_id), "late").when(F.col(self.key).isNull(), "keyless").otherwise("first")
        rows = batch.select(*columns, kind.alias("_kind"))
        # The smallest struct of a key is one row; other rows pass as they are.
        least = rows.filter("_kind = 'first'").groupBy(self.key).agg(F.min(F.struct(F.col(self.ts).alias("_time"), *columns, "_kind")).alias("_r"))
        least = least.select(*(F.col("_r")[c].alias(c) for c in [*columns, "_kind"]))
        self.staged.put(least.unionByName(rows.filter("_kind <> 'first'")), batch_id)
        staged = self.staged.batch(batch_id)
        asked = self._hashed(staged.filter("_kind = 'first'"))
        known = self._known(asked, batch_id)
        fresh = asked if known is None else asked.join(known, self.key, "left_anti")
        self.first.put(fresh.select(*columns).unionByName(staged.filter("_kind = 'keyless'").select(*columns)), batch_id)
        fresh = self._hashed(self.first.batch(batch_id).filter(F.col(self.key).isNotNull()))
        self.seen.put(fresh, batch_id)
        self.bits.put(fresh.groupBy(F.col("_page").alias("page")).agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("bits")), batch_id)
        self.late.put(staged.filter("_kind = 'late'"), batch_id)
        got = batch.select(self.ts).agg(F.max(self.ts).alias("newest"), F.count(F.lit(1)).alias("arrived"))
        late = staged.filter("_kind = 'late'").agg(F.count(F.lit(1)).alias("late"))
        self.marks.put(got.join(F.broadcast(late)), batch_id)

    def rows(self) -> DataFrame:
        return self.first.read()

    def report(self) -> DataFrame:
        """One row: rows that ``arrived``, ``first`` of their key, ``late`` and ``repeated``, and ``remembered`` keys."""
        counts = {"arrived": self.marks.read().agg(F.sum("arrived")), "late": self.marks.read().agg(F.sum("late"))}
        counts |= {name: df.agg(F.count(F.lit(1))) for name, df in (("first", self.first.read()), ("remembered", self.seen.read()))}
        one = self.spark.range(1).select(*(F.coalesce(df.scalar(), F.lit(0)).alias(name) for name, df in counts.items()))
        return one.withColumn("repeated", F.expr("arrived - first - late"))

    def merge(self, through: int) -> None:
        """Fold finished batches up to ``through`` together and forget keys that are older than the horizon."""
        young = F.coalesce(F.col(self.ts) >= self.horizon(through + 1), F.lit(True))
        self.seen.merge(through, lambda rows: rows.filter(young))
        slots = self._hashed(self.seen.read(through + 1))
        pages = slots.groupBy(F.col("_page").alias("page")).agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("bits"))
        self.bits.merge(through, lambda _: pages)
        self.marks.merge(through, lambda rows: rows.agg(F.max("newest").alias("newest"), F.sum("arrived").alias("arrived"), F.sum("late").alias("late")))

    def run(self, sdf: DataFrame, checkpoint: str, once: bool = True, interval: str = "1 minute") -> StreamingQuery:
        return start(sdf, self.update, checkpoint, once, interval)
