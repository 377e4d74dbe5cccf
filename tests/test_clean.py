"""The four golden rows, bad lines, timestamp forms and the loads built on them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom.functions.columns import clip, days_since, finite_or, lenient_ts, parse_event_ts, tier
from eventloom.operators.clean import clean_events, cleaning_report, dedup, union_all, warehouse_rows
from eventloom.plans import jobs
from eventloom.schema import EVENT_SCHEMA
from eventloom.session import scratch_path
from eventloom.sources import events as se, layout, records, warehouse

COLUMNS = EVENT_SCHEMA.names
# The rows that every cleaning rule is checked against.
GOLDEN = [
    ("evt-001", "U0001", "view", "P0100", "2026-07-20T10:30:00+00:00", "product_detail", "google", 15000, "mobile", "Chrome"),
    ("evt-002", "U0002", "purchase", None, "2026-07-20T11:00:00+00:00", "checkout", None, -100, "desktop", "Firefox"),
    ("evt-003", "U0001", "CLICK", "P0200", "2026-07-20T12:00:00+00:00", "home", "direct", 400000, "tablet", "Safari"),
    ("evt-004", None, "view", "P0300", "2026-07-20T13:00:00+00:00", "home", "google", 5000, "mobile", "Chrome"),
]


@pytest.fixture()
def golden_path(tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(json.dumps(dict(zip(COLUMNS, r))) for r in GOLDEN) + "\n")
    return str(path)


def by_id(df):
    return {r["event_id"]: r for r in df.collect()}


def test_reads_all_rows(spark, golden_path):
    assert se.read_events_json(spark, golden_path).count() == 4


def test_filter_keeps_rows_in_range(spark, golden_path):
    rows = by_id(clean_events(se.read_events_json(spark, golden_path)))
    assert set(rows) == {"evt-001"}
    assert rows["evt-001"]["event_ts"] == dt.datetime(2026, 7, 20, 10, 30)


def test_clip_keeps_rows_and_fills(spark, golden_path):
    rows = by_id(clean_events(se.read_events_json(spark, golden_path), mode="clip"))
    assert set(rows) == {"evt-001", "evt-002", "evt-003"}
    assert rows["evt-002"]["product_id"] == "unknown"
    assert rows["evt-002"]["referrer"] == "direct"
    assert rows["evt-003"]["event_type"] == "click"
    assert rows["evt-002"]["duration_ms"] == 0
    assert rows["evt-003"]["duration_ms"] == 300000


def test_unknown_mode_is_refused(spark, golden_path):
    with pytest.raises(ValueError):
        clean_events(se.read_events_json(spark, golden_path), mode="drop")


def test_bad_lines_and_values(spark, tmp_path):
    good = dict(zip(COLUMNS, GOLDEN[0]))
    lines = [json.dumps(good), "{not json", json.dumps({**good, "event_id": "evt-005", "duration_ms": 1.5})]
    (tmp_path / "e.jsonl").write_text("\n".join(lines) + "\n")
    raw = se.read_events_json(spark, str(tmp_path / "e.jsonl"))
    assert raw.count() == 3
    rows = by_id(clean_events(raw))
    assert set(rows) == {"evt-001", "evt-005"}
    assert rows["evt-005"]["duration_ms"] is None
    kept = se.read_events_json(spark, str(tmp_path / "e.jsonl"), corrupt_column="bad").cache()
    assert "{not json" in [r["bad"] for r in kept.collect()]


def test_timestamp_forms(spark):
    forms = {
        "2026-07-20T10:30:00.123456+00:00": dt.datetime(2026, 7, 20, 10, 30, 0, 123456),
        "2026-07-20T10:30:00+08:00": dt.datetime(2026, 7, 20, 2, 30),
        "2026-07-20T10:30:00": dt.datetime(2026, 7, 20, 10, 30),
        "20/07/2026": None,
        "": None,
    }
    df = spark.createDataFrame([(t,) for t in forms], "t string")
    got = {r["t"]: (r["a"], r["b"]) for r in df.select("t", parse_event_ts("t").alias("a"), lenient_ts("t").alias("b")).collect()}
    assert {t: a for t, (a, _) in got.items()} == forms
    assert got["20/07/2026"][1] is None


def test_cleaning_report(spark, golden_path):
    raw = se.read_events_json(spark, golden_path)
    row = cleaning_report(raw, F.to_date(parse_event_ts("timestamp"))).first()
    assert (row["raw_rows"], row["dropped_null_key"], row["dropped_duration"], row["clean_rows"]) == (4, 1, 2, 1)
    assert row["retention_pct"] == 25.0 and row["partitions"] == 1


def test_dedup_keeps_the_earliest(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", None, "only")], "event_id string, event_ts int, tag string")
    assert {r["event_id"]: r["tag"] for r in dedup(df).collect()} == {"a": "early", "b": "only"}


def test_dedup_cuts_copies_before_the_shuffle(spark, sf_dir):
    from eventloom.sources.testtables import user_events

    plan = dedup(user_events(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2,)], "i int")
    assert sorted((r["i"], r["s"]) for r in union_all(a, b).collect()) == [(1, "x"), (2, None)]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    got = df.select(clip("x", 0.0, 3.0).alias("c"), finite_or("x", 0, 999, -999).alias("f")).collect()
    assert [r["c"] for r in got[:3]] == [0.0, 3.0, None]
    assert [r["f"] for r in got] == [-1.0, 5.0, 0.0, 0.0, 999.0, -999.0]
    assert [r[0] for r in spark.range(0, 120, 40).select(tier("id", (100, 50, 10), ("hot", "warm", "cool", "cold"))).collect()] == ["cold", "cool", "warm"]
    with pytest.raises(ValueError):
        tier("id", (1, 2), ("a",))
    days = spark.sql("SELECT DATE '2024-01-01' AS d").select(
        days_since("d", F.lit("2024-01-03 12:00:00")).alias("f"), days_since("d", F.lit("2024-01-03 12:00:00"), True).alias("i")
    ).first()
    assert (days["f"], days["i"]) == (2.5, 2)


def test_partitioned_write_counts_and_replaces_only_its_partitions(spark, golden_path, tmp_path):
    out = str(tmp_path / "out")
    raw = se.read_events_json(spark, golden_path)
    first = clean_events(raw, mode="clip", run_ts=F.lit("2026-07-21"))
    assert se.write_events(first, out) == 3
    second = clean_events(raw, run_ts=F.lit("2026-07-21"))
    assert se.write_events(second, out) == 1
    assert spark.read.parquet(out).count() == 3  # click and purchase partitions are untouched
    assert se.write_events(second, out, replace="all") == 1
    assert spark.read.parquet(out).count() == 1


def test_unreadable_files_by_their_ends(spark, tmp_path):
    """Short, cut and foreign files are found by a few bytes each, also below folders whose names need encoding."""
    folder = tmp_path / "t" / "a b=ü%20c"
    spark.range(5).coalesce(1).write.parquet(str(folder / "good"))
    whole = next((folder / "good").glob("*.parquet")).read_bytes()
    for name, data in {"empty": b"", "short": b"PAR1PAR1", "cut": whole[:-1], "foreign": b"x" * 50, "copy": whole}.items():
        (folder / f"{name}.parquet").write_bytes(data)
    found = se.unreadable_files(spark, str(tmp_path / "t"))
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in found.collect()) == [f"{n}.parquet" for n in ("cut", "foreign", "short")]
    # The empty file is no row of either list: readers pass over it.
    for name in ("cut", "foreign", "short"):
        (folder / f"{name}.parquet").unlink()
    assert se.unreadable_files(spark, str(tmp_path / "t")).count() == 0
    assert se.read_parquet_tree(spark, str(tmp_path / "t"), merge_schema=False).count() == 10
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_parquet_tree_skips_unreadable_files(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), "unknown"), (2, 1.0, "x")], "ID int, Val double, Tag string")
    df.write.parquet(str(tmp_path / "t/a/b"))
    (tmp_path / "t/broken.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        se.read_parquet_tree(spark, str(tmp_path / "t")).collect()
    got = se.read_parquet_tree(spark, str(tmp_path / "t"), missing_words=("unknown",), skip_corrupt=True)
    assert [r["path"].rsplit("/", 1)[-1] for r in se.unreadable_files(spark, str(tmp_path / "t")).collect()] == ["broken.parquet"]
    assert got.columns == ["id", "val", "tag"]
    assert sorted(map(tuple, got.collect())) == [(1, None, None), (2, 1.0, "x")]


def test_sample_is_stable_and_bounded(spark):
    df = spark.range(1000)
    a = {r["id"] for r in se.sample_rows(df, 10, "id").collect()}
    b = {r["id"] for r in se.sample_rows(df.repartition(7), 10, "id").collect()}
    assert a == b and len(a) == 10
    assert se.sample_rows(df, 5000, "id").count() == 1000


def test_csv_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([("a,b", None), ('say "hi"', "x")], "p string, q string")
    se.write_csv(df.coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("*.csv")).read_text()
    assert text.splitlines()[0] == '"p","q"' and '"a,b",""' in text
    back = se.read_csv(spark, str(tmp_path / "c"), ["p", "q"]).collect()
    assert sorted((r["p"], r["q"] or "") for r in back) == [("a,b", ""), ('say "hi"', "x")]


def test_record_roundtrip_and_bad_record(spark, golden_path):
    raw = se.read_events_json(spark, golden_path)
    sent = records.encode_records(raw)
    assert sent.columns == ["key", "value", "topic"]
    assert sorted(map(tuple, records.decode_records(sent).collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)
    bad = spark.createDataFrame([(bytearray(b"{oops"),)], "value binary")
    assert records.decode_records(bad).first()["event_id"] is None


def test_warehouse_rows(spark, golden_path):
    raw = se.read_events_json(spark, golden_path)
    rows = by_id(warehouse_rows(union_all(raw, raw)))
    assert len(rows) == 4 and rows["evt-003"]["event_type"] == "CLICK" and rows["evt-002"]["product_id"] == "unknown"


def test_availability_reports_missing_tables(spark):
    got = {r["table_name"]: r for r in warehouse.availability(spark, {"gone": "gone_table", "one": spark.range(1), "none": spark.range(0)}).collect()}
    assert (got["gone"]["row_count"], got["gone"]["available"]) == (0, False) and "gone_table" in got["gone"]["error"]
    assert got["one"]["available"] and not got["none"]["available"]


def test_inspection(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "p"))
    row = layout.inspect_output(spark, str(tmp_path / "p")).first()
    assert row["files"] == 4 and row["bytes"] > 0 and row["usable"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        layout.check_output(spark, str(tmp_path / "empty"))


def test_compaction_choices(spark, tmp_path):
    spark.range(1000).withColumn("d", F.col("id") % 2).repartition(20).write.parquet(str(tmp_path / "s"))

    def files(name, **how):
        layout.compact(spark, str(tmp_path / "s"), str(tmp_path / name), **how)
        assert spark.read.parquet(str(tmp_path / name)).count() == 1000
        return len(list((tmp_path / name).rglob("*.parquet")))

    assert files("c", files=3) == 3
    assert files("r", files=5, shuffle=True) == 5
    assert files("b", by=("d",)) == 2
    assert files("a") == 1


def test_batch_job(spark, golden_path, tmp_path):
    assert jobs.clean_files(spark, golden_path, str(tmp_path / "out"), F.lit("2026-07-21")) == 1
    (tmp_path / "none.jsonl").write_text("")
    with pytest.raises(ValueError):
        jobs.clean_files(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "out2"))


def test_catalog_names_answer_the_sample_queries(spark, golden_path, sf_dir):
    """The four sample statements with their own table names, against catalog tables."""
    from eventloom.sources.testtables import TEST_ROLES, raw_events

    base = scratch_path(spark, "catalog")
    warehouse.create_raw_table(spark, "raw.user_events", f"{base}/raw")
    assert warehouse.load_warehouse(raw_events(spark, sf_dir)) == 10_000
    jobs.build_models(spark, base, roles=TEST_ROLES)
    jobs.build_models(spark, base, roles=TEST_ROLES)  # a second build replaces the contents
    texts = [
        "SELECT event_type, COUNT(*) as cnt FROM raw.user_events GROUP BY event_type ORDER BY cnt DESC",
        "SELECT user_segment, COUNT(*) as users, SUM(total_events) as events FROM public_clean.dim_users GROUP BY user_segment",
        "SELECT * FROM public_clean.fct_user_events_daily ORDER BY event_date DESC LIMIT 10",
        "SELECT * FROM public_clean.dim_products ORDER BY conversion_rate_pct DESC LIMIT 10",
    ]
    counts = [spark.sql(t).count() for t in texts]
    assert counts[0] == 10 and counts[1] >= 1 and counts[2:] == [10, 10]


def test_views_over_globs_and_frames(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "g/x=1"))
    spark.range(7).write.parquet(str(tmp_path / "g/x=2"))
    se.glob_view(spark, str(tmp_path / "g/*/*.parquet"), "globbed")
    se.register_view(spark.range(3), "framed")
    assert spark.sql("SELECT COUNT(*) FROM globbed").first()[0] == 12
    assert spark.sql("SELECT COUNT(*) FROM framed").first()[0] == 3


def test_table_schema_and_limit(spark):
    spark.range(9).selectExpr("id", "cast(id as string) as s").createOrReplaceTempView("nine")
    got = [(r["column_name"], r["data_type"]) for r in warehouse.table_schema(spark, "nine").orderBy("position").collect()]
    assert got == [("id", "bigint"), ("s", "string")]
    assert [r["id"] for r in warehouse.read_table(spark, "nine", 3, ("id",)).collect()] == [0, 1, 2]
    assert warehouse.read_table(spark, "nine").count() == 9


def test_written_report(spark, tmp_path):
    from eventloom.sources import layout

    spark.range(1000).selectExpr("cast(id as string) as s").coalesce(2).write.parquet(str(tmp_path / "out"))
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
    row = layout.written_report(spark, str(tmp_path / "out"), 1000).first()
    assert (row["bytes"], row["clean_rows"], row["raw_estimate_mb"]) == (size, 1000, 512_000 / 2**20)
    assert row["compression_pct"] == round(size * 100 / 512_000, 1) and row["files"] >= 1 and row["usable"]
    assert layout.written_report(spark, str(tmp_path / "out"), 0).first()["compression_pct"] is None
