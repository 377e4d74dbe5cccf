"""The pipeline on a small table, stage by stage against brute force."""

import re
from collections import Counter

import corpus_pipeline
from eventloom.llm import mixing, quality, toxicity
from eventloom.session import scratch_path
from tests.llm import cases
from tests.llm.test_operators import brute_jaccard, check_packed, labelled


def test_pipeline(spark):
    table, labels, _, _ = labelled(spark)
    extra = [(2000 + i, t, *rest) for i, (_, t, *rest) in enumerate(cases.rows())]
    d = scratch_path(spark, "pipeline-test")
    table.unionByName(spark.createDataFrame(extra, cases.DOCS)).write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        out.write.parquet(f"{d}/{name}")
        kept[name] = spark.read.parquet(f"{d}/{name}")
        assert name == names[-1] or kept[name].columns == docs.columns
        docs = kept[name]
    start = spark.read.parquet(f"{d}/documents.parquet")
    known = spark.read.parquet(f"{d}/labels.parquet")

    def texts(df):
        return Counter((r["doc_id"], r["text"]) for r in df.collect())

    scored = {r["doc_id"]: r["score"] for r in toxicity.score_documents(start, toxicity.train(start, known)).collect()}
    assert texts(kept["toxicity"]) == Counter({k: n for k, n in texts(start).items() if scored[k[0]] < 0.3})
    scored = {r["doc_id"]: r["score"] for r in quality.score_documents(kept["toxicity"], known).collect()}
    assert texts(kept["quality"]) == Counter({k: n for k, n in texts(kept["toxicity"]).items() if scored[k[0]] >= quality.AT_THRESHOLD})
    rows = [tuple(r) for r in kept["quality"].collect()]
    first = {c for _, _, c in brute_jaccard(rows)}
    assert texts(kept["near_copies"]) == Counter({(r[0], r[1]): 1 for r in rows if r[0] in first})
    assert texts(kept["mixing"]) == texts(mixing.mixed_documents(kept["near_copies"]))
    count = lambda df: Counter({s: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in df.filter(df.source.eqNullSafe(s)).collect()) for s in [r[0] for r in df.select("source").distinct().collect()]})
    assert sum(count(kept["mixing"]).values()) > 1.3 * sum(count(kept["near_copies"]).values())
    mixed = [tuple(r) for r in kept["mixing"].collect()]
    check_packed(kept["packing"].collect(), mixed)
    run = Counter(map(tuple, corpus_pipeline.run(spark, d).collect()))
    assert run == Counter(map(tuple, kept["packing"].collect()))
