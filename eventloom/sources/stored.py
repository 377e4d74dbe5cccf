"""Stored log records as a stream with its own offsets: bounded micro-batches, and runs that stop after so many rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from eventloom.schema import RECORD_SCHEMA
from eventloom.sources.records import decode_records
from eventloom.streaming.live import BATCH, BatchTable, folders

_ARROW = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", "UTC")),
])
# Offsets that one task reads at most.
TASK_OFFSETS = 1_000_000
# Offsets up to which small ranges share a task.
SHARED_OFFSETS = 40_000
# Rows and bytes of a row group, and rows of a file, of records dealt out in order.
GROUP_ROWS, GROUP_BYTES, FILE_ROWS = 4096, 8 << 20, 250_000
# Tasks a core that a trigger of several batches is made for, and batches that it takes at most.
CORE_TASKS, TOGETHER = 2, 1000
# What an offset tells of the batches up to it besides the partitions: where the first begins, its number, and offsets a batch.
BEGIN, NUMBER, STEP = "begin", "number", "step"


def share(available: Mapping[str, int], rows: int) -> dict[str, int]:
    """``rows`` dealt out evenly, one at a time in order of partition, to partitions that still have some."""
    out, left = dict.fromkeys(available, 0), min(rows, sum(available.values()))
    while left:
        open_ = sorted((p for p in available if out[p] < available[p]), key=int)
        step = min(left // len(open_), min(available[p] - out[p] for p in open_))
        for p in open_ if step else open_[:left]:
            out[p] += step or 1
        left -= step * len(open_) or min(left, len(open_))
    return out


def _step(at: Mapping[str, int], target: Mapping[str, int], rows: int) -> dict[str, int]:
    return share({p: max(0, target[p] - at[p]) for p in target}, rows)


@dataclass
class OffsetRange:
    partition: int
    start: int
    end: int
    files: list[str]
    batch: int | None = None


@dataclass
class OffsetRanges(InputPartition):
    ranges: list[OffsetRange]


class StoredRecordReader(DataSourceStreamReader):
    """Offsets are the next record of each partition. A batch goes ``per_batch`` offsets further, up to the target of the run.

    A trigger takes one batch. With ``number``, that of the run's first batch, it takes up to ``together`` of them and a row
    tells its batch in ``batch_id``; the offset says how they are cut, so a trigger that is made again has the same ones.

    ``ordered`` names files, each with the offsets ``low`` to ``high`` of a partition, that hold every record from where the
    run begins up to its target; a task opens those of its offsets only. Any other offsets are looked up in the whole folder.
    """

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.per_batch = int(options.get("perBatch", 1 << 62))
        self.at, self.target = json.loads(options["start"]), json.loads(options["target"])
        self.first = dict(self.at)
        self.ordered = json.loads(options.get("ordered", "null"))
        self.together, self.number = int(options.get("together", 1)), json.loads(options.get("number", "null"))
        self.told = self.at

    def initialOffset(self) -> dict:
        return self.first

    def latestOffset(self) -> dict:
        begin, number = self.at, self.number
        for _ in range(self.together):
            step = _step(self.at, self.target, self.per_batch)
            if not any(step.values()):
                break
            self.at = {p: self.at[p] + step[p] for p in self.target}
            if number is not None:
                self.number += 1
        if self.at != begin:
            self.told = self.at if number is None else {**self.at, BEGIN: begin, NUMBER: number, STEP: self.per_batch}
        return self.told

    def _batches(self, start: Mapping[str, int], end: Mapping) -> Iterator[tuple[int | None, dict[str, int], dict[str, int]]]:
        """Number, first offsets and next offsets of each batch."""
        to = {p: n for p, n in end.items() if p not in (BEGIN, NUMBER, STEP)}
        if BEGIN not in end:
            yield None, {p: start.get(p, 0) for p in to}, to
            return
        at, number = {p: end[BEGIN].get(p, 0) for p in to}, end[NUMBER]
        while any((step := _step(at, to, end[STEP])).values()):
            yield number, at, (at := {p: at[p] + step[p] for p in to})
            number += 1

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        tasks, held = [], SHARED_OFFSETS
        for number, begin, to in self._batches(start, end):
            # A batch that fits a task is not dealt to two.
            if held + min(sum(to[p] - begin[p] for p in to), SHARED_OFFSETS) > SHARED_OFFSETS:
                held = SHARED_OFFSETS
            for p in to:
                for s in range(begin[p], to[p], TASK_OFFSETS):
                    e = min(s + TASK_OFFSETS, to[p])
                    if held + e - s > SHARED_OFFSETS:
                        tasks.append(OffsetRanges([]))
                        held = 0
                    tasks[-1].ranges.append(OffsetRange(int(p), s, e, self._files(p, s, e), number))
                    held += e - s
            if self.number is not None:
                self.number = max(self.number, number + 1) if number is not None else self.number + 1
        # A batch that is made again after a restart may lie ahead of where this run began.
        at = {p: max(self.at[p], end.get(p, 0)) for p in self.at}
        if at != self.at:
            self.at, self.told = at, end
        return tasks

    def _files(self, partition: str, start: int, end: int) -> list[str]:
        if self.ordered is None or not (self.first.get(partition, end) <= start and end <= self.target.get(partition, start)):
            return [self.path]
        return [file for file, low, high in self.ordered.get(partition, []) if low < end and start <= high]

    def read(self, partition: OffsetRanges) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        # Ranges of several batches that follow one another are read at once.
        place = lambda r: (r.partition, r.files == [self.path])
        for (number, _), group in groupby(sorted(partition.ranges, key=lambda r: (*place(r), r.start)), place):
            ranges = list(group)
            starts, batches = np.array([r.start for r in ranges]), np.array([r.batch for r in ranges])
            wanted = (ds.field("partition") == number) & (ds.field("offset") >= ranges[0].start) & (ds.field("offset") < ranges[-1].end)
            for file in dict.fromkeys(file for r in ranges for file in r.files):
                records = ds.dataset(file, format="parquet", exclude_invalid_files=False)
                for batch in records.to_batches(columns=_ARROW.names, filter=wanted):
                    if batch.num_rows:
                        rows = pa.Table.from_batches([batch]).cast(_ARROW)
                        if self.number is not None:
                            of = batches[np.searchsorted(starts, rows["offset"].to_numpy(), side="right") - 1]
                            rows = rows.append_column(BATCH, pa.array(of.tolist(), pa.int64()))
                        yield rows.combine_chunks().to_batches()[0]


class StoredRecords(DataSource):
    """Format ``stored_records``: Parquet files of records (see ``RECORD_SCHEMA``) that Arrow can open by path or URI."""

    @classmethod
    def name(cls) -> str:
        return "stored_records"

    def schema(self):
        numbered = [T.StructField(BATCH, T.LongType())] if "number" in self.options else []
        return T.StructType([*RECORD_SCHEMA.fields, *numbered])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return StoredRecordReader(self.options)


class RecordLog:
    """What has been consumed of a folder of stored records: rows by micro-batch below ``path``, and their offsets.

    ``consume`` takes up where the last run ended, takes ``stop_after`` rows at most (all that are there at the start if
    None) and hands back how many it took. Rows are put under the batch's id, and a batch that broke off is
    made again from the same offsets, so every record arrives once. Partitions take turns in the order of their numbers.
    The limit counts offsets: where a partition has gaps, fewer rows come. ``offsets`` has a row for each batch and
    partition; a run puts those of its batches when it ends, and until then the rows themselves tell them.

    A trigger of the stream reads several batches at once, some tasks for every core, and writes each into a folder of its
    own; the folders are then put one after another. Those of a trigger that broke off which were not put are made again by
    the next run, also beyond its limit.
    """

    def __init__(self, spark: SparkSession, source: str, path: str) -> None:
        self.spark, self.source, self.path = spark, source, path
        self.rows = BatchTable(spark, f"{path}/records", RECORD_SCHEMA)
        self.offsets = BatchTable(spark, f"{path}/offsets", "`partition` int, next long, rows long")

    def _put(self, folder: str, batch_id: int) -> None:
        self.rows.take(folder, batch_id)

    def _put_all(self, batches: DataFrame, trigger: int) -> None:
        """The batches of one trigger; the function that ``foreachBatch`` calls."""
        # Only a trigger begun before batches were numbered has rows without one.
        rows = batches.withColumn(BATCH, F.coalesce(F.col(BATCH), F.lit(trigger).cast("long")))
        path = f"{self.path}/begun/{uuid.uuid4().hex[:12]}"
        rows.filter(F.col(BATCH) > self.last).write.partitionBy(BATCH).parquet(path)
        for batch_id, folder in folders(self.spark, path, BATCH):
            self._put(folder, batch_id)
            self.last = batch_id

    def _done(self) -> int:
        """The last batch with its offsets put, -1 if there is none."""
        return self.offsets.batches().agg(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0]

    def _new(self) -> DataFrame:
        """Offsets of the batches since."""
        new = self.rows.batches().filter(F.col(BATCH) > self._done()).groupBy(BATCH, "partition")
        return new.agg((F.max("offset") + 1).alias("next"), F.count(F.lit(1)).alias("rows"))

    def _taken(self) -> dict[str, tuple[int, int]]:
        """Next offset and rows taken, by partition of the log."""
        out = {}
        for offsets in (self.offsets.read(), self._new()):
            for r in offsets.groupBy("partition").agg(F.max("next").alias("next"), F.sum("rows").alias("rows")).collect():
                next_, rows = out.get(p := str(r["partition"]), (0, 0))
                out[p] = max(next_, r["next"]), rows + r["rows"]
        return out

    def taken(self) -> int:
        return sum(rows for _, rows in self._taken().values())

    def _in_order(self, start: Mapping[str, int], target: Mapping[str, int]) -> dict[str, list]:
        """The records from ``start`` up to ``target`` once more, by partition and offset: file, first and last offset by partition."""
        path = f"{self.path}/ordered/{uuid.uuid4().hex[:12]}"
        bounds = self.spark.createDataFrame([(int(p), start[p], target[p]) for p in target], "`partition` int, _start long, _target long")
        wanted = self.spark.read.schema(RECORD_SCHEMA).parquet(self.source).join(F.broadcast(bounds), "partition")
        wanted = wanted.filter((F.col("offset") >= F.col("_start")) & (F.col("offset") < F.col("_target")))
        files = -(-sum(target[p] - start[p] for p in target) // FILE_ROWS)
        rows = wanted.withColumn("timestamp", F.unix_micros("timestamp")).select(*RECORD_SCHEMA.names)
        rows = rows.repartitionByRange(files, "partition", "offset").sortWithinPartitions("partition", "offset")
        groups = {"parquet.block.row.count.limit": str(GROUP_ROWS), "parquet.block.size": str(GROUP_BYTES)}
        rows.write.options(**groups).parquet(path)
        held = self.spark.read.parquet(path).groupBy("partition", F.col("_metadata.file_name").alias("file"))
        out = {}
        for r in held.agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect():
            out.setdefault(str(r["partition"]), []).append([f"{path}/{r['file']}", r["low"], r["high"]])
        return out

    def consume(self, stop_after: int | None = None, per_batch: int | None = None) -> int:
        self.spark.dataSource.register(StoredRecords)
        ends = self.spark.read.schema(RECORD_SCHEMA).parquet(self.source).groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
        # One row per partition of the log.
        done, state = self._taken(), ends.collect()
        end = {str(r["partition"]): r["high"] + 1 for r in state}
        start = {str(r["partition"]): done[str(r["partition"])][0] if str(r["partition"]) in done else r["low"] for r in state}
        room = share({p: end[p] - start[p] for p in end}, sum(end.values()) if stop_after is None else stop_after)
        before, target = sum(rows for _, rows in done.values()), {p: start[p] + room[p] for p in start}
        self.last = kept = self._done()
        number = max(kept, self._new().agg(F.coalesce(F.max(BATCH), F.lit(-1))).first()[0]) + 1
        options = {"path": self.source, "start": json.dumps(start), "target": json.dumps(target), "number": str(number)}
        if per_batch is not None:
            options["perBatch"] = str(per_batch)
            offsets = CORE_TASKS * self.spark.sparkContext.defaultParallelism * SHARED_OFFSETS
            options["together"] = str(min(max(1, offsets // per_batch), TOGETHER))
            if sum(room.values()) > per_batch:
                # Several batches would each look through the whole folder.
                options["ordered"] = json.dumps(self._in_order(start, target))
        stream = self.spark.readStream.format("stored_records").options(**options).load()
        query = stream.writeStream.foreachBatch(self._put_all).option("checkpointLocation", f"{self.path}/checkpoint").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
            # Batches up to here are complete, also where the run broke off.
            if self.last > kept:
                self.offsets.put(self._new().filter(F.col(BATCH) <= self.last), self.last)
        return self.offsets.read().agg(F.sum("rows")).first()[0] - before if self.last > kept else 0

    def events(self) -> DataFrame:
        return decode_records(self.rows.read())
