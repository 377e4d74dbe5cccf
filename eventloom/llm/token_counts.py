"""Token counts of documents from distinct pre-tokens, without making ids of any document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import in_pieces, stored, texts
from eventloom.llm.tokens import PieceEncoder

# Distinct pre-tokens that one task counts before it hands them on.
FLUSH = 400_000


def _split(encoder: PieceEncoder, text: str) -> list[str]:
    return encoder.library_pieces(text) if encoder.odd(text) else encoder.split(text)


def piece_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each distinct pre-token of the corpus once: ``piece``, ``uses`` in all documents, ``n_tokens``.

    Tasks count before the shuffle, so a frequent pre-token is one row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = PieceEncoder(tokenizer), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "uses"])
            seen.clear()
            return out

        for batch in in_pieces(batches):
            for text in texts(batch):
                seen.update(_split(encoder, text))
            if len(seen) > FLUSH:
                yield flush()
        yield flush()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer)
        for batch in batches:
            lengths = encoder.piece_lengths(batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.int64())], ["piece", "uses", "n_tokens"])

    distinct = docs.select("text").mapInArrow(count, "piece string, uses long").groupBy("piece").agg(F.sum("uses").alias("uses"))
    return distinct.mapInArrow(measure, "piece string, uses long, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, common: int = 1_000_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    The pieces of each distinct pre-token are counted once. Per document, pre-token frequencies are joined to that
    table and summed. Pre-tokens that make up at least 1 / ``common`` of all uses - so never more than ``common`` of
    them, whatever the corpus - are looked up in a broadcast table while the document is read; frequencies of all
    others meet the table in a shuffled join.

    ``n_bytes`` is the UTF-8 length; null text counts as empty: 0 bytes, 0 tokens. Repeated rows, also of the same
    id, give one row each. A null id stays null. No rows give no rows. Other columns are ignored.
    The file's normalizer must be empty.
    """
    spark = docs.sparkSession
    pieces = stored(piece_table(docs, tokenizer), "pieces")
    total = pieces.agg(F.sum("uses")).first()[0] or 0
    head = pieces.filter(F.col("uses") * common >= total).select("piece", "n_tokens").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(head.column(0).to_pylist(), head.column(1).to_pylist())))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = PieceEncoder(tokenizer), known.value
        for batch in in_pieces(batches, 1_000_000):
            sums, key, size, piece, uses = [], [], [], [], []
            for k, n, text in zip(batch.column("_k").to_pylist(), batch.column("n_bytes").to_pylist(), texts(batch)):
                found = _split(encoder, text)
                counts = list(map(table.get, found))
                if None in counts:
                    rare = Counter(p for p, c in zip(found, counts) if c is None)
                    piece += rare.keys()
                    uses += rare.values()
                    key += [k] * len(rare)
                    size += [n] * len(rare)
                    sums.append(sum(filter(None, counts)))
                else:
                    sums.append(sum(counts))
            n, m = batch.num_rows, len(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("_k").to_pylist() + key, pa.int64()),
                    pa.array(batch.column("n_bytes").to_pylist() + size, pa.int64()),
                    pa.array(batch.column("doc_id").to_pylist() + [None] * m, pa.int64()),
                    pa.array([1] * n + [0] * m, pa.int64()),
                    pa.array([None] * n + piece, pa.string()),
                    pa.array(sums + uses, pa.int64()),
                ],
                ["_k", "n_bytes", "doc_id", "row", "piece", "uses"],
            )

    rows = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64("doc_id", "text").alias("_k"),
    ).mapInArrow(split, "_k long, n_bytes long, doc_id long, row long, piece string, uses long")
    rows = stored(rows, "piece-uses")
    whole = rows.filter("row = 1").select("_k", "n_bytes", "doc_id", "row", F.col("uses").alias("_sum"))
    rare = rows.filter("row = 0").select("_k", "n_bytes", "piece", "uses")
    joined = rare.join(pieces.select("piece", "n_tokens"), "piece").select(
        "_k", "n_bytes", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("row"),
        (F.col("uses") * F.col("n_tokens")).alias("_sum"),
    )
    # Equal rows share a key: their sums are equal, so the sum is divided by the number of rows and given to each.
    summed = whole.unionByName(joined).groupBy("_k", "n_bytes").agg(
        F.max("doc_id").alias("doc_id"), F.sum("row").alias("_n"), F.sum("_sum").alias("_sum")
    )
    each = summed.select("doc_id", "n_bytes", F.expr("_sum div _n").alias("n_tokens"), F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
