"""Document quality by Bradley-Terry pairwise ranking over plain text measures."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import held_out, in_pieces, stored, texts

# Bounds of the fit, whatever the corpus: labelled documents of each class, and pairs drawn from them.
SAMPLE_PER_CLASS, PAIRS = 4_000, 60_000
# Scores are counted in cells of this width between -CLIP and CLIP to find a quantile of all labelled rows exactly.
CELL, CLIP = 1e-3, 50.0
# The score that stands at the threshold.
AT_THRESHOLD = 0.7

NAMES = (
    "log_words", "word_length", "distinct_words", "upper_letters", "digits", "symbols", "end_marks", "marked_words",
    "doubled_words", "commonest_word", "distinct_lines", "line_length", "commonest_line", "letters", "no_text",
)
_UPPER, _DIGIT, _MARK, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91], _DIGIT[48:58] = True, True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()"]] = True


def measures(text: str) -> np.ndarray:
    """The numbers that a text is judged by, each near 0 to 1 except logarithms. The empty text has only its own mark."""
    out = np.zeros(len(NAMES))
    words = text.split()
    if not words:
        out[-1] = 1.0
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(raw, minlength=256)
    inked = max(1, int(kinds[~_SPACE].sum()))
    letters = max(1, int(kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum()))
    n = len(words)
    counts = Counter(words)
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    out[0] = np.log1p(n) / 10
    out[1] = min(inked / n, 40) / 10
    out[2] = len(counts) / n
    out[3] = kinds[_UPPER].sum() / letters
    out[4] = kinds[_DIGIT].sum() / inked
    out[5] = kinds[_MARK].sum() / inked
    out[6] = min(1.0, (kinds[46] + kinds[33] + kinds[63]) * 5 / n)
    out[7] = sum(v for w, v in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:'\")") / n
    out[8] = sum(map(str.__eq__, words, words[1:])) / n
    out[9] = max(counts.values()) / n
    out[10] = len(line_counts) / max(1, len(lines))
    out[11] = np.log1p(n / max(1, len(lines))) / 10
    out[12] = sum(len(x) * (v - 1) for x, v in line_counts.items()) / max(1, len(text))
    out[13] = letters / inked
    return out


@dataclass(frozen=True)
class Ranking:
    """Bradley-Terry strengths: the strength of a document is linear in its standardised measures."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self._basis(rows) @ self.weights, -CLIP, CLIP)

    def _basis(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.middle) / self.spread, -6, 6)
        return np.hstack([x, np.maximum(x, 0) ** 2, np.minimum(x, 0) ** 2])

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, and ``AT_THRESHOLD`` at the threshold."""
        return 1 / (1 + np.exp(-(self.strength(rows) - self.threshold)) * (1 - AT_THRESHOLD) / AT_THRESHOLD)


def fit_pairs(better: np.ndarray, worse: np.ndarray, rounds: int = 300, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights that minimise the mean logistic loss of the differences ``better - worse``. Adam on all pairs."""
    diff = better - worse
    w, m, v = (np.zeros(diff.shape[1]) for _ in range(3))
    for step in range(1, rounds + 1):
        g = -(diff.T @ (1 / (1 + np.exp(np.clip(diff @ w, -500, 500))))) / len(diff) + decay * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, measures`` of every whole text: one pass, and no text after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            rows = pa.array([measures(t).tolist() for t in texts(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "measures"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, measures array<double>")


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(NAMES)))


def train(table: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking | None:
    """Fit strengths from preference pairs (a document of label 1 over one of label 0) and set the threshold.

    Pairs come from at most ``SAMPLE_PER_CLASS`` labelled documents of each class in a fixed random order, ``PAIRS``
    pairs in all. The threshold is a quantile of the strengths of all labelled rows that are not held out: the one
    that leaves as many rows below it as there are rows of label 0. None without rows of both classes.
    """
    usable = labels.filter(~held_out()).select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    known = stored(table.join(usable.dropDuplicates(["doc_id"]), "doc_id"), "quality-labelled")
    order = F.md5(F.col("doc_id").cast("string"))
    sides = [_stack(known.filter(F.col("label") == y).orderBy(order, "doc_id", "measures").limit(SAMPLE_PER_CLASS).select("measures").toPandas()["measures"]) for y in (0, 1)]
    if not len(sides[0]) or not len(sides[1]):
        return None
    both = np.vstack(sides)
    model = Ranking(both.mean(0), both.std(0) + 1e-6, np.zeros(3 * len(NAMES)))
    dice = np.random.default_rng(7)
    worse, better = (model._basis(s)[dice.integers(0, len(s), PAIRS)] for s in sides)
    model = Ranking(model.middle, model.spread, fit_pairs(better, worse))

    @F.pandas_udf("double")
    def strength(rows: pd.Series) -> pd.Series:
        return pd.Series(model.strength(_stack(rows)))

    cells = known.select(F.floor(strength("measures") / CELL).alias("cell"), "label").groupBy("cell").agg(F.count("*").alias("n"), F.sum(1 - F.col("label")).alias("low"))
    found = cells.orderBy("cell").toPandas()  # at most 2 * CLIP / CELL rows
    low = int(found["low"].sum())
    below = found["n"].cumsum().to_numpy()
    at = min(int(np.searchsorted(below, low)), len(found) - 1)
    # The middle of the gap above that quantile.
    over = min(at + 1, len(found) - 1)
    return Ranking(model.middle, model.spread, model.weights, float((found["cell"][at] + 1 + found["cell"][over]) / 2 * CELL))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, score, strength`` of every document; ``score`` is ``AT_THRESHOLD`` at the fitted quantile.

    Null and empty texts are measured as such and scored by the model. Repeated rows give a row each; a null id stays
    null and is never learned from. Labels other than 0 and 1 are ignored. Without labels of both classes the score is
    ``AT_THRESHOLD`` for all. No rows give no rows. Other columns are ignored.
    """
    table = stored(measured(docs), "quality-measures")
    model = train(table, labels, label)
    if model is None:
        return table.select("doc_id", F.lit(AT_THRESHOLD).alias("score"), F.lit(0.0).alias("strength"))

    @F.pandas_udf("score double, strength double")
    def judge(rows: pd.Series) -> pd.DataFrame:
        x = _stack(rows)
        return pd.DataFrame({"score": model.score(x), "strength": model.strength(x)})

    return table.withColumn("_j", judge("measures")).select("doc_id", "_j.score", "_j.strength")


def good_documents(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The documents that score at least ``AT_THRESHOLD``, all columns kept; fitted on these documents' labels."""
    model = train(stored(measured(docs), "quality-measures"), labels, label)
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def kept(text: pd.Series) -> pd.Series:
        rows = np.stack([measures(t or "") for t in text]) if len(text) else np.zeros((0, len(NAMES)))
        return pd.Series(model.strength(rows) >= model.threshold)

    return docs.filter(kept("text"))
