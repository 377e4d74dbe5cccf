"""Latent semantic vectors: texts near each other by the company that their words keep, without a downloaded model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators.embed import ENCODE_BATCH, _Slots, apply_encoder, fit_lexical

# Directions weaker than this share of the strongest carry rounding noise only.
WEAKEST = 1e-10


def _weighted(slots: _Slots, texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Rows of the term matrix: (1 + ln count) times rarity, at unit length; a text without words is a zero row."""
    counts = slots.counts(texts)
    rows = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass(frozen=True)
class SemanticModel:
    """Rarity of each slot, the directions (a column each, strongest first) and their singular values."""

    idf: np.ndarray
    basis: np.ndarray
    strength: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(-1, None, self.strength.tolist()), *zip(range(len(self.idf)), self.idf.tolist(), self.basis.tolist())]
        spark.createDataFrame(rows, "slot int, idf double, basis array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SemanticModel:
        first, *rest = spark.read.parquet(path).orderBy("slot").collect()
        return SemanticModel(np.array([r["idf"] for r in rest]), np.array([r["basis"] for r in rest]), np.array(first["basis"]))


def _product(texts: DataFrame, idf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Transposed term matrix times term matrix times ``start``: each task adds up its own rows, the sum comes back."""
    slots_n, width = start.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, total = _Slots(slots_n), np.zeros((slots_n, width))
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODE_BATCH):
                rows = _weighted(slots, batch.slice(at, ENCODE_BATCH).column(0).to_pylist(), idf)
                used = np.flatnonzero(rows.any(axis=0))
                rows = rows[:, used]
                total[used] += rows.T @ (rows @ start[used])
        kept = np.flatnonzero(total.any(axis=1))
        for at in range(0, len(kept), 1024):
            some = kept[at : at + 1024]
            offsets = pa.array(np.arange(0, len(some) * width + 1, width, dtype=np.int32))
            values = pa.ListArray.from_arrays(offsets, pa.array(total[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), values], ["slot", "part"])

    parts = texts.mapInArrow(partial, "slot int, part array<double>")
    added = parts.groupBy("slot").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("row")).toArrow()
    out = np.zeros((slots_n, width))
    if added.num_rows:
        out[added["slot"].to_numpy()] = added["row"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    return out


def fit_semantic(
    df: DataFrame, col: str, dim: int = 128, slots: int = 8192, extra: int = 8, rounds: int = 2, seed: int = 7, tasks: int | None = None
) -> SemanticModel:
    """Learn the ``dim`` strongest directions of the term matrix of all texts (randomised range finder).

    Words are dealt to ``slots`` columns by hash. A random start of ``dim + extra`` columns is multiplied by the matrix and
    its transpose, ``rounds`` + 1 times, and made orthogonal in between; the small matrix that is left gives the directions.
    Every product is one pass over all texts. A task holds ``slots`` times ``dim + extra`` numbers (9 MB) and hands back the
    rows of slots it has met; the driver holds as many, whatever the number of texts. ``tasks`` merges input partitions, to
    bound what is handed back.

    Null texts count as empty. Where texts have fewer directions than ``dim`` the others are zero.
    """
    texts = df.select(F.col(col))
    if tasks is not None:
        texts = texts.coalesce(tasks)
    idf = np.array(fit_lexical(texts, col, slots).idf)
    width = min(dim + extra, slots)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((slots, width)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(_product(texts, idf, basis))[0]
    small = basis.T @ _product(texts, idf, basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[: min(dim, width)]
    values, basis = np.maximum(values[order], 0), basis @ turn[:, order]
    # The sign of a direction is free: its largest entry is made positive.
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    basis = basis * (values > WEAKEST * max(values.max(initial=0), 1e-300))
    return SemanticModel(idf, basis, np.sqrt(values))


def apply_semantic(df: DataFrame, col: str, model: SemanticModel, out: str = "embedding") -> DataFrame:
    """Unit vectors of texts in the model's directions; queries must use the model of their corpus.

    A text of which no word is in the model's directions is a zero vector.
    """
    slots_n, dim = model.basis.shape

    def encoder():
        slots = _Slots(slots_n)
        return lambda texts: _weighted(slots, texts, model.idf) @ model.basis

    return apply_encoder(df, col, encoder, dim, out, per_task=True)
