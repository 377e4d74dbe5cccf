"""Large groups of near copies: links stay in proportion, components stay whole."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.llm import jaccard
from tests.llm import cases


def _near_copies(n, seed=1):
    dice = random.Random(seed)
    words = ["".join(dice.choice("abcdefghij") for _ in range(6)) for _ in range(70)]
    rows = []
    for i in range(n):
        own = list(words)
        own[dice.randrange(70)] = f"changed{i}"
        rows.append((i, " ".join(own), "en", "s", 1, None, None))
    return rows


def _reach(rows):
    """Components of rows that differ from one text in one word: by the places changed."""
    sets = []
    for r in rows:
        w = r[1].split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in range(len(rows))}


@pytest.mark.parametrize("n", [500, 1000])
def test_links_grow_with_documents(spark, monkeypatch, n):
    made = []
    real = jaccard.components

    def counted(edges):
        made.append(edges.count())
        return real(edges)

    monkeypatch.setattr(jaccard, "components", counted)
    rows = _near_copies(n)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, cases.DOCS)).collect()}
    assert got == _reach(rows)
    assert sum(made) <= 16 * n


def test_clashing_columns_come_back(spark):
    docs = cases.documents(spark)
    for name in ("_h", "h", "row", "top", "ka", "component_id"):
        docs = docs.withColumn(name, F.concat(F.lit(name), "doc_id"))
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    for r in kept.collect():
        if r["doc_id"] is not None:
            assert all(r[name] == f"{name}{r['doc_id']}" for name in ("_h", "h", "row", "top", "ka", "component_id"))
