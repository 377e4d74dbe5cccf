"""Search, embedding and retrieval against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.functions.text import event_chunks, event_text, product_text
from eventloom.functions.vectors import inner_product, l2_normalize
from eventloom.operators import embed, retrieval, search
from eventloom.plans import queries


def _vectors(spark, n, dim, seed, copies=0):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    if copies:
        v[:copies] = v[0]  # a third of the corpus may be one vector
    return v, spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, embedding array<float>")


def _brute(corpus, queries, k):
    scores = np.round(queries.astype(np.float64) @ corpus.astype(np.float64).T, search.SCORE_DIGITS)
    return {q: list(np.lexsort((np.arange(len(corpus)), -row))[:k]) for q, row in enumerate(scores)}


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.fixture(scope="module")
def small(spark):
    cv, corpus = _vectors(spark, 600, 8, 1, copies=200)
    qv, queries = _vectors(spark, 25, 8, 2)
    return cv, corpus.repartition(5), qv, queries.withColumnRenamed("id", "query_id")


def test_one_block(small):
    cv, corpus, qv, queries = small
    assert _got(search.topk_exact(corpus, queries, 7)) == _brute(cv, qv, 7)


def test_bad_vectors_take_no_part(spark, small):
    cv, corpus, qv, queries = small
    bad = [(1000, [float("nan")] * 8), (1001, [float("inf")] + [1.0] * 7), (1002, [9.0] * 7), (1003, [9.0] * 9), (1004, []), (1005, None), (1006, [None] + [9.0] * 7)]
    mixed = corpus.unionByName(spark.createDataFrame(bad, "id long, embedding array<float>"))
    asked = queries.unionByName(spark.createDataFrame(bad[:2] + bad[4:], "query_id long, embedding array<float>"))
    assert _got(search.topk_exact(mixed, asked, 7)) == _brute(cv, qv, 7)
    other = spark.createDataFrame([(5, [1.0] * 9)], "query_id long, embedding array<float>")
    assert _got(search.topk_exact(mixed, other, 7)) == {5: [1003]}


def test_grid_of_blocks(small, monkeypatch):
    cv, corpus, qv, queries = small
    monkeypatch.setattr(search, "CORPUS_BLOCK_BYTES", 70 * 64)
    monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 6 * 64)
    monkeypatch.setattr(search, "QUERY_SLICE", 4)
    assert _got(search.topk_exact(corpus, queries, 7)) == _brute(cv, qv, 7)


def test_exact_search_leaves_the_corpus_in_place(spark, small, tmp_path, monkeypatch):
    """Blocks of a few rows on both sides, of two lengths: every pair is scored, and no shuffle carries a corpus vector."""
    cv, corpus, qv, queries = small
    monkeypatch.setattr(search, "PACKED_BYTES", 70 * 64)
    monkeypatch.setattr(search, "ASKED_BYTES", 6 * 64)
    mixed = corpus.unionByName(spark.createDataFrame([(1000 + i, [1.0, float(i)]) for i in range(9)], "id long, embedding array<double>"))
    asked = queries.unionByName(spark.createDataFrame([(500, [0.0, 1.0])], "query_id long, embedding array<double>"))
    mixed.write.parquet(str(tmp_path / "c"))
    asked.write.parquet(str(tmp_path / "q"))
    out = search.topk_exact(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "q")), 3)
    assert _got(out) == _brute(cv, qv, 3) | {500: [1008, 1007, 1006]}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "FlatMapCoGroups" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ties_within_the_rounding_go_to_the_smaller_id(spark):
    vectors = [(i, [1.0 + (i % 7) * 1e-11, 0.0]) for i in range(300, 0, -1)] + [(None, [0.5, 0.0])]
    corpus = spark.createDataFrame(vectors, "id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert _got(search.topk_exact(corpus, asked, 4)) == {1: [1, 2, 3, 4]}


def test_fewer_rows_than_k(small):
    cv, corpus, qv, queries = small
    got = _got(search.topk_exact(corpus, queries, 10, where=F.col("id") >= 596))
    assert all(len(h) == 4 for h in got.values())


def test_queries_from_the_corpus_itself(spark, small):
    cv, corpus, _, _ = small
    asked = corpus.select(F.col("id").alias("query_id"), "embedding")
    assert _got(search.topk_exact(corpus, asked, 3)) == _brute(cv, cv, 3)
    few = corpus.filter("id < 5").select(F.col("id").alias("query_id"), "embedding")
    assert _got(search.topk_exact(corpus, few, 3, where=F.col("id") >= 0)) == _brute(cv, cv[:5], 3)


def test_pruned_search(spark, small, tmp_path, monkeypatch):
    cv, corpus, qv, queries = small
    monkeypatch.setattr(search, "CORPUS_BLOCK_BYTES", 70 * 64)
    monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 6 * 64)
    built = search.build_ivf(corpus, str(tmp_path / "ivf"), nlist=8)
    index = search.ClusterIndex.open(spark, str(tmp_path / "ivf"))
    assert np.allclose(built.centers, index.centers)
    full = _got(search.topk_ivf(spark, index, queries, 7, nprobe=8))
    assert full == _brute(cv, qv, 7)
    some = search.topk_ivf(spark, index, queries, 7, nprobe=3)
    near = search._nearest(qv.astype(np.float64), index.centers, 3)
    home = {r["id"]: r["cluster"] for r in index.vectors(spark).collect()}
    scores = np.round(qv.astype(np.float64) @ cv.astype(np.float64).T, search.SCORE_DIGITS)
    for q, ids in _got(some).items():
        allowed = [i for i in range(len(cv)) if home[i] in near[q]]
        assert ids == sorted(allowed, key=lambda i: (-scores[q][i], i))[:7]
    row = search.recall(some, search.topk_exact(corpus, queries, 7)).first()
    assert 0 < row["recall"] <= 1 and row["exact_hits"] == 25 * 7


def test_pruned_search_reads_only_probed_clusters(spark, small, tmp_path):
    _, corpus, _, queries = small
    index = search.build_ivf(corpus, str(tmp_path / "ivf"), nlist=8)
    one = queries.filter("query_id = 3")
    plan = search.topk_ivf(spark, index, one, 5, nprobe=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster" in plan or "PartitionFilters: [(cluster" in plan


def test_index_size_rule():
    assert [search.nlist_for(n) for n in (5, 100, 550, 10**9)] == [2, 10, 23, 31623]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    rows = df.select(inner_product("v", "v").alias("p"), l2_normalize("v").alias("u")).collect()
    assert rows[0]["p"] == 25.0 and rows[0]["u"] == [0.6, 0.8] and rows[1]["u"] == [0.0, 0.0]


def test_lexical_embedding_finds_its_text(spark):
    texts = ["red shoes on sale", "blue winter jacket", "cheap phone case", "green garden chair", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    model = embed.fit_lexical(docs, "text")
    corpus = embed.apply_lexical(docs, "text", model)
    asked = embed.apply_lexical(spark.createDataFrame([(0, "winter jacket in blue")], "query_id long, text string"), "text", model)
    assert search.topk_exact(corpus, asked, 1).first()["id"] == 1
    assert {len(r["embedding"]) for r in corpus.collect()} == {384}


def test_user_encoder_runs_in_batches(spark):
    def lengths(batch):
        assert len(batch) <= embed.ENCODE_BATCH
        return np.array([[len(t), 1.0] for t in batch])

    df = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(500)] + [(500, None)], "id long, text string")
    rows = embed.embed_text(df, "text", encoder=lengths, dim=2).collect()
    assert len(rows) == 501
    for r in rows:
        n = len(r["text"] or "")
        assert r["embedding"] == pytest.approx([n / np.hypot(n, 1), 1 / np.hypot(n, 1)], abs=1e-6)


def test_text_builders(spark):
    row = spark.createDataFrame(
        [("e1", None, None, "unknown", "", "direct", None, None, None, 0), ("e2", "U1", "view", "P1", "home", "google", "mobile", "Chrome", "toys", 5)],
        "event_id string, user_id string, event_type string, product_id string, page string, referrer string, device string, browser string, product_category string, duration_ms long",
    )
    a, b = event_text(row).orderBy("event_id").collect()
    assert a["text_content"] == "事件类型: unknown，用户: unknown"
    assert b["text_content"] == "事件类型: view，用户: U1，商品: P1，页面: home，来源: google，设备: mobile，浏览器: Chrome"
    c, d = event_chunks(row, lo=60).orderBy("event_id").collect()
    assert c["chunk"] == "Event e1: User ? performed ?"
    assert d["chunk"] == "User U1 performed view on product P1 (category: toys) from google on page home via mobile Chrome duration 5ms"
    cut = [r["chunk"] for r in event_chunks(row, hi=30).filter("event_id = 'e2'").orderBy("chunk_no").collect()]
    assert " ".join(cut) == d["chunk"] and max(map(len, cut)) <= 30 and len(cut) > 3
    long = row.withColumn("page", F.lit("x" * 70)).filter("event_id = 'e2'")
    cut = [r["chunk"] for r in event_chunks(long, hi=30).orderBy("chunk_no").collect()]
    assert "".join(cut).count("x") == 70 and max(map(len, cut)) <= 30
    assert event_text(long.withColumn("page", F.lit("y" * 3000))).first()["text_content"].count("y") == 3000
    p = spark.createDataFrame([("P1", 0, 2, 12.5), ("P2", 3, 0, None)], "product_id string, total_views long, total_purchases long, conversion_rate_pct double")
    assert [r["text_content"] for r in product_text(p).orderBy("product_id").collect()] == ["商品ID: P1，购买次数: 2，转化率: 12.5%", "商品ID: P2，浏览次数: 3"]


def test_prompt_without_hits_and_with_own_instruction(spark):
    hits = spark.createDataFrame([(1, 1, "view", "U1", "", "some text")], "query_id long, rank int, event_type string, user_id string, product_id string, chunk string")
    asked = spark.createDataFrame([(1, "why?"), (2, "who?")], "query_id long, question string")
    got = {r["query_id"]: r["prompt"] for r in retrieval.build_prompts(hits, asked, system="Be brief.").collect()}
    assert got[1].startswith("Be brief.\n\n## Context (retrieved from data platform)\n1. [Event: view | User: U1 | Product: N/A]\n   some text\n\n## User Question\nwhy?")
    assert got[1].endswith("## Answer") and "who?" in got[2]


def test_missing_metadata_gets_defaults(spark):
    hits = spark.createDataFrame([(1, 7, 0.5, 1)], "query_id long, id long, score double, rank int")
    meta = spark.createDataFrame([(8, "view", "U1", "P1", "c")], "id long, event_type string, user_id string, product_id string, chunk string")
    for most in (None, 1):
        row = search.attach_metadata(hits, meta, retrieval.HIT_DEFAULTS, most).first()
        assert (row["event_type"], row["user_id"], row["product_id"], row["chunk"]) == ("?", "?", "", "")


def test_hits_are_broadcast_and_the_corpus_is_not_shuffled(spark, small, tmp_path):
    _, corpus, _, queries = small
    corpus.withColumn("tag", F.lit("t")).write.parquet(str(tmp_path / "c"))
    out = retrieval.search_rows(spark.read.parquet(str(tmp_path / "c")), queries, {"tag": ""}, 3)
    assert out.count() == 75
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(id" not in plan


def test_no_queries_and_no_rows(small):
    _, corpus, _, queries = small
    assert search.topk_exact(corpus, queries.filter("query_id < 0"), 3).count() == 0
    assert search.topk_exact(corpus.filter("id < 0"), queries, 3).count() == 0


def test_hit_rate_depends_on_k(spark):
    hits = spark.createDataFrame([(1, 1, "view"), (1, 2, "click"), (2, 1, "view")], "query_id long, rank int, event_type string")
    want = spark.createDataFrame([(1, "click"), (2, "view"), (3, "view")], "query_id long, expected_type string")
    assert retrieval.hit_rate(hits, want, 10).first()["hits"] == 2
    assert retrieval.hit_rate(hits, want, 1).first()["hits"] == 1


def test_knowledge_base_roundtrip_and_text_questions(spark, tmp_path):
    rows = [(f"e{i}", f"U{i % 5}", ("purchase", "view")[i % 2], "P1", ("cart", "home")[i % 2], "google", "mobile", "Chrome", 10 + i) for i in range(40)]
    ev = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, product_id string, page string, referrer string, device string, browser string, duration_ms long")
    retrieval.build_knowledge_base(ev, str(tmp_path / "kb"))
    kb = retrieval.open_knowledge_base(spark, str(tmp_path / "kb"))
    assert kb.entries.count() == 40
    asked = spark.createDataFrame([(1, "purchase on page cart"), (2, "view on page home")], "query_id long, question string")
    got = kb.ask(asked, 3).collect()
    assert {(r["query_id"], r["event_type"]) for r in got} == {(1, "purchase"), (2, "view")} and len(got) == 6
    only = kb.ask(asked, 3, where=F.col("event_type") == "view").collect()
    assert {r["event_type"] for r in only} == {"view"}


def test_knowledge_base_with_an_encoder(spark, tmp_path):
    def counts(batch):
        return np.array([[t.count("a") + 1.0, t.count("e") + 1.0, len(t)] for t in batch])

    ev = spark.createDataFrame([("e1", "U1", "view", 5)], "event_id string, user_id string, event_type string, duration_ms long").selectExpr(
        "*", "'P1' as product_id", "'home' as page", "'google' as referrer", "'mobile' as device", "'Chrome' as browser"
    )
    kb = retrieval.build_knowledge_base(ev, str(tmp_path / "kb"), encoder=counts, dim=3)
    assert kb.ask(spark.createDataFrame([(1, "a question")], "query_id long, question string"), 1).first()["event_type"] == "view"


def _ranked(vectors, asked, k):
    """Ids and scores of the best rows per question, by brute force on what was stored."""
    scores = np.round(np.array(asked["embedding"].tolist(), float) @ np.array(vectors["embedding"].tolist(), float).T, search.SCORE_DIGITS)
    ids = vectors["id"].to_numpy()
    return {q: [(ids[i], round(row[i], 4)) for i in np.lexsort((ids, -row))[:k]] for q, row in zip(asked["query_id"], scores)}


def _scored(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return out


def test_retrieval_covers_every_event(spark, sf_dir):
    kb = queries._whole_knowledge(spark, sf_dir)
    ids = {r[0] for r in queries.user_events(spark, sf_dir).select("event_id").collect()}
    assert {r[0] for r in kb.select("event_id").distinct().collect()} == ids
    hits = queries.rag_retrieve_all(spark, sf_dir)
    assert _scored(hits) == _ranked(kb.select("id", "embedding").toPandas(), queries._questions(kb).toPandas(), 5)
    with_vector = {str(r[0]) for r in queries.table(spark, sf_dir, "embeddings").select("vec_id").collect()}
    found = {r[0] for r in kb.join(hits.select("id"), "id").select("event_id").collect()}
    assert found - with_vector
    assert queries.rag_hit_rate_all(spark, sf_dir).first()["queries"] == 5
    assert queries.rag_first_types_all(spark, sf_dir).count() == 5
    assert queries.rag_prompt_all(spark, sf_dir).count() == 5
    assert queries.query_intent_all(spark, sf_dir).count() == 5


def test_event_and_product_search_cover_everything(spark, sf_dir):
    vectors = queries._event_vectors(spark, sf_dir)
    assert vectors.count() == queries.user_events(spark, sf_dir).count()
    asked = queries._page_queries(vectors).toPandas()
    bought = vectors.filter(F.lower("event_type") == "purchase").select("id", "embedding").toPandas()
    assert _scored(queries.vector_search_events_all(spark, sf_dir)) == _ranked(bought, asked, 10)
    means = queries._mean_vectors(vectors.filter("product_id IS NOT NULL"), "product_id").toPandas()
    assert len(means) == queries._products(spark, sf_dir).count()
    means["id"] = means["product_id"].str[1:].astype(int)
    assert _scored(queries.vector_search_products_all(spark, sf_dir)) == _ranked(means, asked, 5)
