"""Token ids of documents in files of range-coded chunks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventloom.llm.common import in_pieces, texts
from eventloom.llm.mixture import decode, encode
from eventloom.llm.tokens import worker_encoder

CHUNK, BLOCK = 4_000_000, 1024
SCHEMA = "part int, chunk int, doc_ids array<long>, counts array<long>, payload binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, chunk: int = CHUNK) -> None:
    """Write the ids of every document, each closed by ``end_id``, in ascending order of doc_id below ``path``.

    A file is a Parquet file of chunks: whole documents of about ``chunk`` ids as one payload (see ``mixture``) with the
    ids and lengths of its documents. Chunks are ordered by ``part`` and ``chunk``. Spark's commit keeps files of lost
    or repeated tasks out.

    Null text counts as empty and has the end id only. Rows of one id follow each other by text. Null ids come first.
    A document longer than a chunk is a chunk of its own. No rows give no chunks. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        names, ids, held, done, part = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, done
            counts = [len(x) // 4 for x in ids]
            payload = encode(np.frombuffer(b"".join(ids), "<u4"), BLOCK)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([done], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                ["part", "chunk", "doc_ids", "counts", "payload"],
            )
            names.clear()
            ids.clear()
            held, done = 0, done + 1
            return row

        for batch in in_pieces(batches):
            coded = encoder.ids_of(texts(batch))
            for name, at, raw in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), coded):
                part = at
                names.append(name)
                ids.append(raw + end)
                held += len(ids[-1]) // 4
                if held >= chunk:
                    yield flush()
        if ids:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").withColumn("part", F.spark_partition_id())
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def _decoded(files: DataFrame, schema: str, make) -> DataFrame:
    """Decode chunk by chunk; ``make(part, chunk, doc_ids, counts, ids)`` gives the columns of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                ids = decode(row["payload"])
                yield pa.RecordBatch.from_pydict(make(row["part"], row["chunk"], row["doc_ids"], row["counts"], ids))

    return files.mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` of every document in the files."""

    def make(part, chunk, doc_ids, counts, ids) -> dict:
        ends = np.cumsum(counts)
        rows = [ids[e - c : e].astype(np.int32) for c, e in zip(counts, ends)]
        return {"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(rows, pa.list_(pa.int32()))}

    return _decoded(spark.read.schema(SCHEMA).parquet(path), "doc_id long, ids array<int>", make)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the decoded ids.

    ``start`` counts the ids of all documents before it: those before its chunk come from the chunks' lengths alone.
    """
    files = spark.read.schema(SCHEMA).parquet(path)

    def make(part, chunk, doc_ids, counts, ids) -> dict:
        raw, ends = ids.tobytes(), np.cumsum(counts)
        sums = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for c, e in zip(counts, ends.tolist())]
        return {
            "part": pa.array([part] * len(counts), pa.int32()), "chunk": pa.array([chunk] * len(counts), pa.int32()),
            "doc_id": pa.array(doc_ids, pa.int64()), "within": pa.array(ends - counts, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
        }

    rows = _decoded(files, "part int, chunk int, doc_id long, within long, n_tokens long, ids_crc32 long", make)
    sizes = files.select("part", "chunk", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("size"))
    before = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "chunk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, ["part", "chunk"]).select(
        "doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
