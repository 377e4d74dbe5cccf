"""Every registered query: exact against its oracle, or at least non-empty without one."""

import pytest

import __spark_entry__ as contract
from tests.oracle import differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name])[:3] == []


def test_oracles_are_registered():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_date", "event_type", "total_events", "unique_users", "avg_duration_ms", "total_duration_seconds"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["vector_topk_ivf"])
def test_pruned_search_shape(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    by_query = {}
    for r in rows:
        by_query.setdefault(r["query_id"], []).append(r)
    assert len(by_query) == 10
    for hits in by_query.values():
        hits.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in hits] == list(range(1, 11))
        scores = [r["score"] for r in hits]
        assert scores == sorted(scores, reverse=True)


def test_pruned_search_recall(spark, sf_dir):
    row = QUERIES["ivf_recall"](spark, sf_dir).first()
    assert row["exact_hits"] == 100
    assert 0.4 <= row["recall"] < 1.0
