"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import held_out, in_pieces, stored, texts

# Bounds of the fit, whatever the corpus: labelled documents of each class and features of the model.
SAMPLE_PER_CLASS, FEATURES, LEAST_DOCUMENTS = 3_000, 10_000, 3
# A feature is used if positive documents hold it far more often, its log-likelihood ratio reaches this (p about 2e-5).
LEAST_RATIO = 18.0
# and if the share of other documents that hold it is at most this part of the share of positive ones.
MOST_COMMON = 0.01
HEAD = 4
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """A word and its beginnings of 4 to 6 letters: offensive stems also show with other endings."""
    return [word] + [word[:k] + "*" for k in range(HEAD, HEAD + 3) if len(word) > k]


@dataclass(frozen=True)
class BagModel:
    """Sentence score: sigmoid(bias + sum of the weights of the sentence's features), 0 for a sentence without any.

    So thousands of plain sentences do not add up to a finding.
    """

    weights: dict[str, float]
    bias: float = 0.0

    def reader(self):
        """Function from a sentence to -log(1 - p), which is what it adds to the document's noisy-or."""
        heads, weights, bias = {f[:HEAD] for f in self.weights}, self.weights, self.bias

        def doubt(sentence: str) -> float:
            hits = {w for w in _WORD.findall(sentence.lower()) if w[:HEAD] in heads}
            found = sorted({f for w in hits for f in features(w) if f in weights})
            return float(np.logaddexp(0.0, bias + sum(weights[f] for f in found))) if found else 0.0

        return doubt


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Texts and labels of at most ``per_class`` documents of each class that are not held out, in a fixed random order."""
    usable = labels.filter(~held_out()).select("doc_id", F.col(label).alias("label")).dropDuplicates(["doc_id"])
    picked = None
    for value in (0, 1):
        one = usable.filter(F.col("label") == value).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    # At most 2 * per_class rows by the limits above, so this side is always small enough to broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def fit_bags(words: np.ndarray, sentences: np.ndarray, bags: np.ndarray, labels: np.ndarray, size: int, rounds: int = 300,
             rate: float = 0.1, decay: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the noisy-or log loss of labelled bags.

    ``words`` and ``sentences`` list the features of each sentence (each has some), ``bags`` the bag of each sentence,
    ``labels`` those of the bags; a positive bag without sentences teaches nothing. With A the sum of softplus(z) over a bag's sentences, the bag is positive with probability
    1 - exp(-A). Classes weigh the same in the loss. Adam on the whole sample; ``decay`` is the ridge penalty.
    """
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = -2.0
    positive = labels == 1
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    for step in range(1, rounds + 1):
        z = np.bincount(sentences, w[words], len(bags)) + w[size]
        total = np.bincount(bags, np.logaddexp(0, z), len(labels))
        slope = np.where(positive, -1 / np.expm1(np.clip(total, 0.05, 500)), 1.0) * share
        g_z = slope[bags] / (1 + np.exp(-z))
        g = np.append(np.bincount(words, g_z[sentences], size) + decay * w[:size] / len(labels), g_z.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
    return w[:size], float(w[size])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> BagModel:
    """Fit the sentence model from document labels.

    Features are those that positive documents of the sample hold significantly more often. Sample and features are
    bounded by the constants above, so what comes to the driver does not grow with the corpus. Null labels and held
    out rows are not used. Without rows of both classes no sentence offends.
    """
    sample = stored(labelled_sample(docs, labels, label, per_class), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return BagModel({})

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            counts = (Counter(), Counter())
            for y, t in zip(batch.column("label").to_pylist(), texts(batch)):
                counts[y].update({f for w in set(_WORD.findall(t.lower())) for f in features(w)})
            for y in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts[y].keys(), pa.string()), pa.array([v * y for v in counts[y].values()], pa.int64()), pa.array([v * (1 - y) for v in counts[y].values()], pa.int64())],
                    ["feature", "a", "b"],
                )

    share = sizes[1] / (sizes[0] + sizes[1])
    ratio = F.expr(f"2 * (a * ln(a / ({share} * (a + b))) + if(b = 0, 0D, b * ln(b / ({1 - share} * (a + b)))))")
    found = sample.mapInArrow(document_counts, "feature string, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    found = found.filter(F.col("a") >= LEAST_DOCUMENTS).filter(f"b * {sizes[1]} <= {MOST_COMMON} * a * {sizes[0]}").withColumn("r", ratio).filter(F.col("r") >= LEAST_RATIO)
    names = found.orderBy(F.desc("r"), "feature").limit(FEATURES).select("feature").toArrow().column(0).to_pylist()
    place = {f: i for i, f in enumerate(sorted(names))}
    if not place:
        return BagModel({})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = {f[:HEAD] for f in place}
        for batch in in_pieces(batches):
            rows = []
            for t in texts(batch):
                bag = [{f for w in _WORD.findall(s.lower()) if w[:HEAD] in heads for f in features(w)} for s in _SENTENCE.findall(t)]
                bag = [sorted(place[f] for f in s if f in place) for s in bag]
                bag = [s for s in bag if s]
                rows.append((np.array([i for s in bag for i in s], np.int32).tobytes(), np.array([len(s) for s in bag], np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label").cast(pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                ["doc_id", "label", "words", "lengths"],
            )

    bags = sample.mapInArrow(encode, "doc_id long, label int, words binary, lengths binary").orderBy("doc_id", "words").toArrow().to_pydict()
    lengths = [np.frombuffer(x, np.int32) for x in bags["lengths"]]
    words = np.concatenate([np.frombuffer(x, np.int32) for x in bags["words"]])
    flat = np.concatenate(lengths)
    bag_of = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
    weights, bias = fit_bags(words, np.repeat(np.arange(len(flat)), flat), bag_of, np.array(bags["label"]), len(place))
    return BagModel({f: float(weights[i]) for f, i in place.items() if abs(weights[i]) > 1e-3}, bias)


def score_documents(docs: DataFrame, model: BagModel, sentence_limit: float = 0.3) -> DataFrame:
    """``doc_id, score, offending``: noisy-or of the sentence scores of each whole text.

    ``offending`` lists the sentences that score at least ``sentence_limit``, in order, as structs ``start, length``
    (code points) and ``score``. Null and empty texts have no sentence and score 0. Repeated rows give a row each.
    A null id stays null. No rows give no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubt_of = model.reader()
        for batch in in_pieces(batches):
            scores, spans = [], []
            for t in texts(batch):
                total, found = 0.0, []
                for m in _SENTENCE.finditer(t):
                    doubt = doubt_of(m.group())
                    total += doubt
                    p = -np.expm1(-doubt)
                    if p >= sentence_limit:
                        found.append({"start": m.start(), "length": m.end() - m.start(), "score": float(p)})
                scores.append(float(-np.expm1(-total)))
                spans.append(found)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "offending"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, offending array<struct<start:int,length:int,score:double>>"
    )


def clean_documents(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """The documents that score below ``limit``, all columns kept; the model is fitted on these documents' labels.

    Rows are decided by id and text, so repeated rows stay together and no text is shuffled.
    """
    doubt_limit = -float(np.log1p(-limit))
    doubt_of = train(docs, labels).reader()

    @F.pandas_udf("boolean")
    def kept(text: pd.Series) -> pd.Series:
        return pd.Series([sum(map(doubt_of, _SENTENCE.findall(t or ""))) < doubt_limit for t in text], dtype=bool)

    return docs.filter(kept("text"))
