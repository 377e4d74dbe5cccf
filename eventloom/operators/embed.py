"""Text to unit vectors.

Without an encoder the vectors are lexical: words dealt to slots by md5, counted and weighted by rarity. With one, a
user's batch function (a loaded sentence model, say) runs in Arrow batches on the executors.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

VECTOR_DIM = 384
ENCODE_BATCH = 128

Encoder = Callable[[list[str]], np.ndarray]

_SPACE = re.compile("[ \\t\\n\\r\\f\\v]+")
# Words whose slot a task remembers.
_REMEMBERED = 500_000


class _Slots:
    """Word counts of texts as slot counts. A word is a run of anything but ASCII white space, in lower case."""

    def __init__(self, dim: int) -> None:
        self.dim, self.known = dim, {}

    def of(self, text: str | None) -> list[int]:
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        out = []
        for word in _SPACE.split((text or "").lower()):
            if word:
                slot = known.get(word)
                if slot is None:
                    slot = known[word] = int.from_bytes(hashlib.md5(word.encode()).digest()[:4]) % self.dim
                out.append(slot)
        return out

    def counts(self, texts: list[str | None]) -> np.ndarray:
        slots = [self.of(t) for t in texts]
        rows = np.repeat(np.arange(len(texts)), [len(s) for s in slots])
        flat = np.array([x for s in slots for x in s], np.int64)
        return np.bincount(rows * self.dim + flat, minlength=len(texts) * self.dim).reshape(len(texts), self.dim)


@dataclass(frozen=True)
class LexicalModel:
    """Weight of each slot: ln((texts + 1) / (texts with the slot + 1))."""

    idf: tuple[float, ...]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(list(enumerate(self.idf)), "slot int, idf double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LexicalModel:
        return LexicalModel(tuple(r["idf"] for r in spark.read.parquet(path).orderBy("slot").collect()))


def fit_lexical(df: DataFrame, col: str, dim: int = VECTOR_DIM) -> LexicalModel:
    """Learn word rarity from the texts: one pass, ``dim`` numbers to the driver. Null counts as an empty text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, seen, texts = _Slots(dim), np.zeros(dim, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[list(set(slots.of(text)))] += 1
                texts += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([*seen.tolist(), texts], pa.int64())], ["slot", "n"])

    found = dict(df.select(F.col(col)).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n")).collect())
    texts = found.get(dim, 0)
    return LexicalModel(tuple(float(np.log((texts + 1) / (found.get(s, 0) + 1))) for s in range(dim)))


def apply_lexical(df: DataFrame, col: str, model: LexicalModel, out: str = "embedding") -> DataFrame:
    """Vectors from a fitted lexical model; queries must use the model of their corpus. A text without rare words is a zero vector."""
    weights = np.array(model.idf)
    return apply_encoder(df, col, lambda: (lambda texts, slots=_Slots(len(weights)): slots.counts(texts) * weights), len(weights), out, per_task=True)


def apply_encoder(
    df: DataFrame, col: str, encoder: Encoder | Callable[[], Encoder], dim: int = VECTOR_DIM, out: str = "embedding", per_task: bool = False
) -> DataFrame:
    """Vectors from a user's encoder, ``ENCODE_BATCH`` texts at a time, scaled to unit length.

    With ``per_task`` the encoder is made anew in each task by calling ``encoder``.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors_of = encoder() if per_task else encoder
        for batch in batches:
            for start in range(0, batch.num_rows, ENCODE_BATCH):
                piece = batch.slice(start, ENCODE_BATCH)
                texts = ["" if t is None else t for t in piece.column(col).to_pylist()]
                vectors = np.asarray(vectors_of(texts), dtype=np.float64).reshape(len(texts), dim)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0).astype(np.float32)
                offsets = pa.array(np.arange(0, unit.size + 1, dim, dtype=np.int32))
                column = pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()))
                yield pa.RecordBatch.from_arrays([*piece.columns, column], names=schema.names)

    return df.mapInArrow(encode, schema)


def embed_text(
    df: DataFrame, col: str, encoder: Encoder | None = None, dim: int = VECTOR_DIM, out: str = "embedding", tasks: int | None = None
) -> DataFrame:
    """Add unit vectors of a text column: by ``encoder``, else lexical over this frame.

    ``tasks`` deals the rows out before the work, for an input whose few row groups would make a few long tasks.
    """
    if tasks is not None:
        df = df.repartition(tasks)
    if encoder is not None:
        return apply_encoder(df, col, encoder, dim, out)
    return apply_lexical(df, col, fit_lexical(df, col, dim), out)
