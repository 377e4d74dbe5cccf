"""Cluster tree: bounded leaves, beam search, nothing lost when every leaf is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import search, tree


@pytest.fixture(scope="module")
def clustered(spark):
    dice = np.random.default_rng(1)
    middles = dice.normal(size=(40, 16))
    vectors = np.concatenate([m + 0.15 * dice.normal(size=(50, 16)) for m in middles])
    asked = middles[:20] + 0.15 * dice.normal(size=(20, 16))
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(-1, None), (-2, [float("nan")] * 16), (-3, [1.0])], "id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    return corpus, queries


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


def test_leaves_are_bounded_and_recall_is_high(spark, clustered, tmp_path, monkeypatch):
    corpus, queries = clustered
    monkeypatch.setattr(tree, "PART", 100)
    built = tree.build_tree(corpus, str(tmp_path / "t"), capacity=60, fanout=4)
    sizes = {r["leaf"]: r["n"] for r in built.leaves().collect()}
    assert max(sizes.values()) <= 60 and sum(sizes.values()) == 2000 and len(built.levels()) >= 3
    again = tree.ClusterTree(spark, str(tmp_path / "t"))
    exact = search.topk_exact(corpus.filter("size(embedding) = 16"), queries, 5)
    every = again.topk(queries, 5, nprobe=len(sizes))
    assert _got(every) == _got(exact)
    some = again.topk(queries, 5, nprobe=8)
    assert search.recall(some, exact).first()["recall"] >= 0.9
    assert again.share_read(queries, 8).first()["share"] < 0.35
    # Centres are met node by node: a plan without a centre in it.
    assert again.centers.groupBy("node").count().agg(F.max("count")).first()[0] <= 4


def test_equal_vectors_end(spark, tmp_path):
    corpus = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)] + [(1000, [0.0, 1.0])], "id long, embedding array<float>")
    built = tree.build_tree(corpus, str(tmp_path / "t"), capacity=50, fanout=4)
    assert sorted(r["n"] for r in built.leaves().collect()) == [1, 500]
    asked = corpus.select(F.col("id").alias("query_id"), "embedding").filter("query_id in (3, 1000)")
    assert _got(built.topk(asked, 2, nprobe=9)) == _got(search.topk_exact(corpus, asked, 2))


def test_small_and_empty(spark, tmp_path):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.1])], "query_id long, embedding array<double>")
    built = tree.build_tree(corpus, str(tmp_path / "a"))
    assert built.levels() == [] and _got(built.topk(asked, 5)) == {7: [1, 2]}
    assert tree.build_tree(corpus.limit(0), str(tmp_path / "b")).topk(asked, 5).collect() == []


def test_plan_of_a_search_does_not_grow_with_the_depth(spark, tmp_path):
    corpus = spark.createDataFrame([(i, [float(2 ** (i // 4)), float(i % 4)]) for i in range(40)], "id long, embedding array<double>")
    built = tree.build_tree(corpus, str(tmp_path / "t"), capacity=2, fanout=2)
    assert len(built.levels()) >= 4
    asked = corpus.select(F.col("id").alias("query_id"), "embedding").filter("query_id < 3")
    every = built.topk(asked, 3, nprobe=100)
    assert len(every._jdf.queryExecution().analyzed().toString()) < 100_000
    assert _got(every) == _got(search.topk_exact(corpus, asked, 3))
