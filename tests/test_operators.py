"""Statistics, quality rules, features and learning against brute force on small frames."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import features, learning, quality, stats
from eventloom.plans import models
from eventloom.schema import EventRoles

# --- order statistics ------------------------------------------------------------------------


def test_bins_are_even_with_a_heavy_tail(spark):
    """Values far apart, one value for most rows, and one value only: bins hold few distinct values and ranks are exact."""
    values = [*range(5000), *[7] * 20_000, 10**15, -(10**12)]
    rows = [("tail", v) for v in values] + [("one", 3)] * 50
    df = spark.createDataFrame(rows, "g string, v long")
    hist = df.groupBy("g", "v").agg(F.count("*").alias("c"))
    sizes = {(r["g"], r["b"]): r["k"] for r in stats._binned(hist, ["g"]).groupBy("g", "b").agg(F.count("*").alias("k")).collect()}
    assert max(k for (g, _), k in sizes.items() if g == "tail") <= 3 * 5002 / 256 and sizes[("one", 0)] == 1
    got = {r["g"]: r for r in stats.duration_stats(df, ["g"], "v").collect()}
    ordered, n = sorted(values), len(values)
    assert (got["tail"]["median"], got["tail"]["p95"], got["tail"]["p99"]) == (
        (ordered[(n - 1) // 2] + ordered[n // 2]) / 2, ordered[int(n * 0.95)], ordered[int(n * 0.99)])
    assert (got["one"]["median"], got["one"]["p99"]) == (3.0, 3)


def _stats_frame(spark, seed):
    rng = random.Random(seed)
    rows = []
    rows += [("hot", rng.choice([7, 7, 7, rng.randint(0, 10**6)])) for _ in range(3000)]
    rows += [("outlier", rng.randint(0, 5)) for _ in range(500)] + [("outlier", 10**12)]
    rows += [("one", 42), ("same", 5), ("same", 5), ("negative", -3), ("negative", -8), ("negative", 4)]
    rows += [(None, 1), (None, 3), ("hot", None)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, v long").repartition(6)


@pytest.mark.parametrize("seed", [1, 2])
def test_duration_stats_match_sorted_lists(spark, seed):
    rows, df = _stats_frame(spark, seed)
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    got = {r["g"]: r for r in stats.duration_stats(df, ["g"], "v").collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        values.sort()
        n, r = len(values), got[g]
        at = lambda p: values[int(n * p)] if n > 1 else values[0]
        assert (r["count"], r["min"], r["max"], r["p95"], r["p99"]) == (n, values[0], values[-1], at(0.95), at(0.99))
        assert r["median"] == statistics.median(values)
        assert r["mean"] == pytest.approx(statistics.mean(values))
        assert r["stdev"] == pytest.approx(statistics.stdev(values) if n > 1 else 0.0)


def test_duration_stats_over_everything(spark):
    _, df = _stats_frame(spark, 3)
    row = stats.duration_stats(df.withColumn("all", F.lit(1)), ["all"], "v").first()
    assert row["count"] == df.filter("v is not null").count()


def test_length_stats_of_fractions_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("bbb",), ("cc",), ("dddd",), (None,)], "t string")
    row = stats.length_stats(df, "t").first()
    assert (row["cnt"], row["min"], row["max"], row["avg"], row["median"]) == (4, 1, 4, 2, 3)


# --- models and dashboard --------------------------------------------------------------------


def test_conversion_is_zero_without_purchases_and_null_without_views(spark):
    rows = [("P1", "view"), ("P1", "view"), ("P2", "purchase"), ("P3", "view"), ("P3", "purchase"), ("unknown", "view")]
    df = spark.createDataFrame(rows, "product_id string, event_type string")
    got = {r["product_id"]: r["conversion_rate_pct"] for r in models.dim_products(df).collect()}
    assert got == {"P1": 0.0, "P2": None, "P3": 100.0}


def test_default_roles_of_the_funnel_and_overview(spark):
    types = ["view", "search", "click", "click", "add_to_cart", "add_to_cart", "purchase", "logout"]
    df = spark.createDataFrame([(t, f"U{i % 3}") for i, t in enumerate(types)], "event_type string, user_id string")
    assert [(r["value"], r["pct"]) for r in stats.funnel(df).collect()] == [(4, 100.0), (2, 50.0), (1, 25.0)]
    row = stats.overview(df).first()
    assert (row["total_events"], row["today_orders"], row["today_users"], row["conversion_rate"]) == (8, 1, 3, 25.0)
    none = stats.overview(df.filter("event_type = 'logout'"), EventRoles()).first()
    assert none["conversion_rate"] == 0.0
    rates = stats.step_rates(stats.funnel(df)).collect()
    assert [(r["pct_of_first"], r["pct_of_previous"]) for r in rates] == [(100.0, None), (50.0, 50.0), (25.0, 50.0)]


def test_product_rank(spark):
    dim = spark.createDataFrame([(f"P{i}", 100 - i, i, 1.26) for i in range(6)], "product_id string, total_views long, total_purchases long, conversion_rate_pct double")
    ev = spark.createDataFrame([("P0", "b"), ("P0", "a"), ("P1", None), ("P5", "z")], "product_id string, product_category string")
    want = [("P0", "a", 1.3), ("P1", "unknown", 1.3), ("P2", "unknown", 1.3)]
    assert [(r["product_id"], r["category"], r["conversion_rate"]) for r in stats.product_rank(dim, ev, 3).collect()] == want
    assert stats.product_rank(dim.limit(0), ev, 3).count() == 0


def test_trend_range_is_pushed_to_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("timestamp_seconds(1704067200 + id * 86400) as event_ts", "'view' as event_type").write.parquet(str(tmp_path / "e"))
    df = stats.trend(spark.read.parquet(str(tmp_path / "e")), "2024-01-08", "2024-01-15")
    assert df.count() == 7
    assert "GreaterThanOrEqual(event_ts" in df._jdf.queryExecution().executedPlan().toString()


# --- quality ---------------------------------------------------------------------------------

GOOD = [("a", "view", 10), ("b", "click", 300)]
BAD = [("a", "view", -1), ("a", None, 10), (None, "error", 999_999)]
RULES = [
    quality.Rule("ordered_columns", values=("event_id", "event_type", "duration_ms")),
    quality.Rule("not_null", "event_id"),
    quality.Rule("unique", "event_id"),
    quality.Rule("accepted_values", "event_type", ("view", "click")),
    quality.Rule("min_between", "duration_ms", low=0, high=100),
    quality.Rule("max_between", "duration_ms", low=0, high=300_000),
    quality.Rule("row_count_between", low=1, high=2, severity="warn"),
]


def _dq(spark, rows):
    return spark.createDataFrame(rows, "event_id string, event_type string, duration_ms long")


def test_each_rule_passes_and_fails(spark):
    good = {r["rule"]: r for r in quality.run_suite(_dq(spark, GOOD), RULES).collect()}
    assert len(good) == 7 and all(r["passed"] and r["status"] == "pass" for r in good.values())
    shuffled = _dq(spark, BAD).select("event_type", "event_id", "duration_ms")
    bad = {r["rule"]: r for r in quality.run_suite(shuffled, RULES).collect()}
    assert not any(r["passed"] for r in bad.values())
    assert bad["accepted_values:event_type"]["failures"] == 1  # null passes
    assert bad["row_count_between"]["status"] == "warn"
    summary = quality.suite_summary(quality.run_suite(shuffled, RULES)).first()
    assert (summary["rules"], summary["failed"], summary["warnings"], summary["errors"]) == (7, 7, 1, 6)


def test_failing_rows_and_store(spark, tmp_path):
    df = _dq(spark, BAD)
    assert quality.failing_rows(df, RULES[1]).count() == 1
    assert [tuple(r) for r in quality.failing_rows(df, RULES[2]).collect()] == [("a", 2)]
    quality.store_failures(df, RULES, str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f/rows"))
    assert {r["rule"] for r in stored.collect()} == {"not_null:event_id", "accepted_values:event_type"}


def test_row_rules_share_one_scan(spark, sf_dir):
    from eventloom.sources.testtables import table

    df = table(spark, sf_dir, "events")
    rules = [quality.Rule("not_null", c) for c in ("event_id", "user_id", "event_type")]
    plan = quality.run_suite(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_unique_rule_carries_the_others(spark, sf_dir):
    """One scan for a suite with a unique rule, and the same counts as each rule alone, on an empty frame too."""
    from eventloom.sources.testtables import table

    rules = [quality.Rule("not_null", "user_id"), quality.Rule("unique", "event_id"), quality.Rule("row_count_between", low=1)]
    plan = quality.run_suite(table(spark, sf_dir, "events"), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for rows in (GOOD, BAD, BAD * 3, [(None, None, None)] * 4, []):
        df = _dq(spark, rows)
        alone = sorted(tuple(quality.run_suite(df, [r]).first()) for r in RULES)
        assert sorted(map(tuple, quality.run_suite(df, RULES).collect())) == alone
        twice = [*RULES, quality.Rule("unique", "event_type")]
        found = {r["rule"]: r["failures"] for r in quality.run_suite(df, twice).collect()}
        assert found["unique:event_type"] == quality.duplicate_keys(df, "event_type").count()


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        quality.Rule("looks_nice", "x")


# --- features --------------------------------------------------------------------------------


@pytest.mark.parametrize("seed,ttl", [(1, None), (2, 5000), (3, None)])
def test_point_in_time_matches_brute_force(spark, seed, ttl):
    rng = random.Random(seed)
    start = 1_704_067_200
    # One user holds most rows; times collide; some features lie long before the questions.
    user = lambda: rng.choice(["hot"] * 6 + ["a", "b", "quiet"])
    facts = [(user(), start + rng.randrange(0, 40_000), i) for i in range(300)]
    asked = [(user(), start + rng.randrange(-2_000, 60_000), i) for i in range(200)] + [(None, start, 900), ("hot", None, 901), ("nobody", start, 902)]
    fdf = spark.createDataFrame(facts, "u string, s long, fid int").select("u", F.timestamp_seconds("s").alias("fts"), "fid")
    qdf = spark.createDataFrame(asked, "u string, s long, qid int").select("u", F.timestamp_seconds("s").alias("as_of"), "qid")
    view = features.FeatureView("f", fdf, "u", ("fid",), "fts", ttl)
    got = {r["qid"]: r["fid"] for r in features.point_in_time(qdf, view, "as_of", tie=("fid",), bucket_seconds=1000).collect()}
    want = {}
    for u, t, qid in asked:
        past = [(s, fid) for fu, s, fid in facts if u is not None and t is not None and fu == u and s <= t]
        hit = max(past, default=None)
        want[qid] = None if hit is None or (ttl is not None and t - hit[0] > ttl) else hit[1]
    assert got == want


@pytest.mark.parametrize("ttl,pieces", [(None, 1), (700, 7), (None, 40)])
def test_point_in_time_by_pieces_matches_brute_force(spark, ttl, pieces):
    rng = random.Random(pieces)
    start = 1_704_067_200
    # Nine of ten rows are one user's, within one hour; one moment holds a fifth of all questions.
    user = lambda: rng.choice(["hot"] * 9 + ["a", "z"])
    facts = [(user(), start + rng.randrange(0, 3_600), i) for i in range(200)] + [("z", None, 998), (None, start, 999)]
    asked = [(user(), start + rng.choice([1_800, *(rng.randrange(-10, 5_000) for _ in range(4))]), i) for i in range(300)]
    asked += [(None, start, 900), ("hot", None, 901), ("nobody", start, 902)]
    fdf = spark.createDataFrame(facts, "u string, s long, fid int").select("u", F.timestamp_seconds("s").alias("fts"), "fid")
    qdf = spark.createDataFrame(asked, "u string, s long, qid int").select("u", F.timestamp_seconds("s").alias("as_of"), "qid")
    view = features.FeatureView("f", fdf, "u", ("fid",), "fts", ttl)
    rows = features.point_in_time_pieces(qdf, view, "as_of", ("fid",), pieces).collect()
    want = {}
    for u, t, qid in asked:
        past = [(s, fid) for fu, s, fid in facts if None not in (u, t, s) and fu == u and s <= t]
        hit = max(past, default=None)
        want[qid] = None if hit is None or (ttl is not None and t - hit[0] > ttl) else hit[1]
    assert len(rows) == len(asked) and {r["qid"]: r["fid"] for r in rows} == want


def test_pieces_split_a_hot_hour_evenly(spark):
    """No piece has three times the rows of the median piece, though one user has all rows, and a third at one moment."""
    moment = "timestamp_millis(cast(if(id % 3 = 0, 1000, id) as bigint))"
    fdf = spark.range(6_000).selectExpr("'hot' as u", f"{moment} as fts", "id as fid")
    qdf = spark.range(6_000).selectExpr("'hot' as u", f"{moment} as as_of", "id as qid")
    seen = []
    reader = spark.read.parquet
    view = features.FeatureView("f", fdf, "u", ("fid",), "fts")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", lambda self, path: seen.append(path) or reader(path))
        features.point_in_time_pieces(qdf, view, "as_of", ("fid",), 16)
    sizes = sorted(r["count"] for r in reader(seen[0]).groupBy("_p").count().collect())
    assert len(sizes) == 16 and sizes[-1] < 3 * sizes[8]


def test_point_in_time_pieces_of_nothing(spark):
    view = features.FeatureView("f", spark.createDataFrame([], "u string, fts timestamp, fid int"), "u", ("fid",), "fts")
    some = spark.sql("SELECT 'a' AS u, timestamp_seconds(5) AS as_of, 1 AS qid, 'mine' AS fid, 7 AS _p")
    row = features.point_in_time_pieces(some, view, "as_of", pieces=3).first()
    assert (row["fid"], row["f_fid"], row["f_ts"], row["_p"]) == ("mine", None, None, 7)
    assert features.point_in_time_pieces(some.limit(0), view, "as_of", pieces=3).count() == 0


def test_point_in_time_forms_no_pairs(spark):
    view = features.FeatureView("f", spark.range(10).selectExpr("'x' as u", "timestamp_seconds(id) as fts", "id as fid"), "u", ("fid",), "fts")
    spine = spark.range(10).selectExpr("'x' as u", "timestamp_seconds(id) as as_of")
    plan = features.point_in_time(spine, view, "as_of")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_historical_joins_several_views(spark):
    t = "timestamp_seconds(id * 10)"
    one = features.FeatureView("one", spark.range(3).selectExpr("'u' as u", f"{t} as ts1", "id as x"), "u", ("x",), "ts1")
    two = features.FeatureView("two", spark.range(3).selectExpr("'u' as u", f"{t} as ts2", "id * 100 as y"), "u", ("y",), "ts2", ttl_seconds=5)
    spine = spark.sql("SELECT 'u' AS u, timestamp_seconds(19) AS as_of")
    row = features.historical(spine, [one, two], "as_of").first()
    assert (row["x"], row["y"]) == (1, None)


def test_historical_ties_are_decided_by_named_columns(spark):
    facts = spark.sql("SELECT 'u' AS u, timestamp_seconds(5) AS t, 1 AS fid, 'z' AS v UNION ALL SELECT 'u', timestamp_seconds(5), 2, 'a'")
    view = features.FeatureView("f", facts, "u", ("v", "fid"), "t")
    spine = spark.sql("SELECT 'u' AS u, timestamp_seconds(9) AS as_of")
    assert features.historical(spine, [view], "as_of").first()["v"] == "z"
    assert features.historical(spine, [view], "as_of", {"f": ("fid",)}).first()["v"] == "a"


def test_latest_and_materialize(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 5, "b5"), ("b", None, "none")], "k string, t int, v string")
    view = features.FeatureView("v", df, "k", ("v",), "t")
    assert {r["k"]: r["v"] for r in features.latest(view).collect()} == {"a": "new", "b": "b5"}
    features.materialize(view, str(tmp_path / "m"))
    online = spark.read.parquet(str(tmp_path / "m"))
    assert features.lookup(online, "k", ["b"]).first()["v"] == "b5"
    assert features.lookup(online, "k", None).count() == 2
    assert features.lookup(online, "k", online.filter("k = 'a'")).count() == 1


def test_id_lists(spark):
    df = spark.range(10)
    assert features.lookup(df, "id", [1, 2, 3, 42]).count() == 3


# --- learning --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def users(spark):
    rng = random.Random(5)
    names = ["active"] * 6 + ["new", "regular", "power_user"]
    rows = []
    for i in range(400):
        segment = rng.choice(names)
        base = {"new": 1, "regular": 5, "active": 30, "power_user": 90}[segment]
        rows.append((f"U{i:04d}", segment, base + rng.randint(0, 4), 30.0 + rng.random(), rng.random() * 10))
    df = spark.createDataFrame(rows, "user_id string, user_segment string, total_events long, f double, l double")
    return df.selectExpr(
        "user_id", "user_segment", "cast(total_events as double) total_events", "f as days_since_first_seen", "l as days_since_last_seen",
        "total_events / (f + 1) as events_per_day", "1 / (l + 1) as recency_score", "least(total_events / (l + 1), 100) as activity_score",
    )


def test_stratified_split_is_exact_and_repeatable(spark, users):
    train, test = learning.stratified_split(users)
    n = {r["user_segment"]: r["count"] for r in users.groupBy("user_segment").count().collect()}
    t = {r["user_segment"]: r["count"] for r in test.groupBy("user_segment").count().collect()}
    assert t == {s: int(c * 0.2) for s, c in n.items()}
    assert train.count() + test.count() == users.count()
    assert train.join(test, "user_id").count() == 0
    again = {r["user_id"] for r in learning.stratified_split(users.repartition(5))[1].collect()}
    assert again == {r["user_id"] for r in test.collect()}


def test_model_learns_and_reports(spark, users, tmp_path):
    train, test = learning.stratified_split(users)
    model = learning.fit_segment_model(train, trees=20)
    predicted = model.predict(test)
    row = learning.evaluate(predicted).first()
    assert row["accuracy"] > 0.9 and 0 < row["f1_weighted"] <= 1
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    for ours, theirs in (("accuracy", "accuracy"), ("precision_weighted", "weightedPrecision"), ("recall_weighted", "weightedRecall"), ("f1_weighted", "f1")):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(predicted))
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in predicted.select("probability").collect())
    weights = [r["importance"] for r in model.importance(spark).collect()]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1.0)
    assert learning.class_report(predicted).agg(F.sum("support")).first()[0] == test.count()
    metrics = {k: v for k, v in row.asDict().items() if k != "rows"}
    learning.record_run(spark, str(tmp_path), "r1", {"trees": 20}, metrics, model)
    learning.record_run(spark, str(tmp_path), "r2", {"trees": 20}, metrics, model)
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.filter("run = 'r1'").count() == 1 + 4 + len(learning.FEATURES) and runs.select("run").distinct().count() == 2
    from pyspark.ml import PipelineModel

    loaded = learning.SegmentModel(PipelineModel.load(str(tmp_path / "models/r1")))
    assert loaded.labels == model.labels == sorted(model.labels)


def test_cross_validation(spark, users):
    mean, dev = learning.cross_validate(users, folds=3, trees=5)
    assert 0.8 < mean <= 1.0 and dev < 0.2


def test_class_report_against_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 3, 200), rng.integers(0, 4, 200)
    df = spark.createDataFrame([(f"c{a}", f"c{b}") for a, b in zip(y, p)], "user_segment string, predicted string")
    for r in learning.class_report(df).collect():
        c = int(r["segment"][1:])
        hit, guessed, actual = ((y == c) & (p == c)).sum(), (p == c).sum(), (y == c).sum()
        assert r["support"] == actual
        assert r["precision"] == pytest.approx(hit / guessed if guessed else 0)
        assert r["recall"] == pytest.approx(hit / actual if actual else 0)
