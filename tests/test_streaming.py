"""Streaming jobs: exactly-once landing, stream = batch, alerts in batch and stream form."""

import datetime as dt
import json

from pyspark.sql import functions as F

from eventloom.operators.clean import clean_events
from eventloom.schema import EVENT_SCHEMA
from eventloom.sources.events import read_events_json
from eventloom.streaming import alerts, jobs

COLUMNS = EVENT_SCHEMA.names


def _write(folder, name, events):
    folder.mkdir(exist_ok=True)
    rows = [dict(zip(COLUMNS, e)) for e in events]
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def _event(i, minute=0, kind="view"):
    return (f"e{i}", f"U{i % 3}", kind, "P1", f"2026-07-20T10:{minute:02d}:00", "home", None, 100, "mobile", "Chrome")


def test_landing_is_exactly_once_across_restarts(spark, tmp_path):
    src, out, chk = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "chk")
    _write(src, "a.json", [_event(i) for i in range(5)])

    def run():
        sdf = jobs.read_event_stream(spark, str(src), max_files=1)
        q = jobs.land_stream(sdf, out, chk)
        q.awaitTermination()
        return q

    run()
    assert read_events_json(spark, out).count() == 5
    run()
    assert read_events_json(spark, out).count() == 5
    _write(src, "b.json", [_event(i) for i in range(5, 8)])
    _write(src, "c.json", [_event(i) for i in range(8, 9)])
    q = run()
    assert read_events_json(spark, out).count() == 9
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 2  # one file per micro-batch


def test_stream_clean_equals_batch_clean(spark, tmp_path):
    _write(tmp_path / "in", "a.json", [_event(i, i) for i in range(10)] + [(None, *_event(1)[1:])])
    stamp = F.lit("2026-07-21")
    sdf = jobs.clean_stream(jobs.read_event_stream(spark, str(tmp_path / "in")), run_ts=stamp)
    jobs.land_stream(sdf, str(tmp_path / "out"), str(tmp_path / "chk"), fmt="parquet", by=("processing_date",)).awaitTermination()
    columns = [*COLUMNS, "event_ts"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    want = clean_events(read_events_json(spark, str(tmp_path / "in")), run_ts=stamp).select(*columns)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and got.count() == 10


def _memory(sdf, name, mode="append"):
    q = sdf.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return q


def test_duplicates_across_batches_are_dropped(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.json", [_event(1), _event(2), _event(1)])
    _write(src, "b.json", [_event(2), _event(3)])
    cleaned = jobs.clean_stream(jobs.read_event_stream(spark, str(src), max_files=1))
    _memory(jobs.dedup_stream(cleaned, "1 hour"), "deduped")
    assert sorted(r["event_id"] for r in spark.table("deduped").collect()) == ["e1", "e2", "e3"]


def test_stream_windows_equal_batch_windows(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.json", [_event(i, i, "purchase" if i % 4 == 0 else "view") for i in range(40)])
    sdf = jobs.clean_stream(jobs.read_event_stream(spark, str(src)))
    batch = clean_events(read_events_json(spark, str(src)))
    for slide in (None, "5 minutes"):
        want = {r["window_start"]: (r["events"], r["purchases"]) for r in jobs.window_counts(batch, "10 minutes", slide).collect()}
        name = f"w_{'t' if slide is None else 's'}"
        _memory(jobs.window_counts(sdf, "10 minutes", slide, watermark="1 minute"), name)
        got = {r["window_start"]: (r["events"], r["purchases"]) for r in spark.table(name).collect()}
        assert got and all(want[w] == v for w, v in got.items())
    # The sliding counts agree with counting each event in every window that holds it.
    direct = batch.groupBy(F.window("event_ts", "10 minutes", "5 minutes").alias("w")).count()
    assert {r["w"]["start"]: r["count"] for r in direct.collect()} == {w: v[0] for w, v in want.items()}


def _at(minute, second=0):
    return dt.datetime(2026, 7, 20, 10, minute, second)


def test_failure_rate(spark, tmp_path):
    rows = [(_at(0), "ok"), (_at(1), "bad"), (_at(2), "ok"), (_at(8), "ok"), (_at(9), "other")]
    df = spark.createDataFrame(rows, "event_ts timestamp, event_type string")
    rates = {r["window_start"]: (r["failures"], r["total"]) for r in alerts.failure_rate(df, ["bad"], ["ok"]).collect()}
    assert rates[_at(0)] == (1, 3) and rates[_at(1)] == (1, 2) and rates[_at(4)] == (0, 1)
    hot = {r["window_start"] for r in alerts.rate_alert(alerts.failure_rate(df, ["bad"], ["ok"])).collect()}
    assert _at(0) in hot and _at(4) not in hot
    df.write.parquet(str(tmp_path / "r"))
    sdf = spark.readStream.schema(df.schema).parquet(str(tmp_path / "r"))
    _memory(alerts.failure_rate(sdf, ["bad"], ["ok"], watermark="10 seconds"), "rates")
    streamed = {r["window_start"]: (r["failures"], r["total"]) for r in spark.table("rates").collect()}
    assert streamed and all(rates[w] == v for w, v in streamed.items())


def test_absence_and_hold(spark):
    df = spark.createDataFrame([(_at(0),), (_at(1),), (_at(9),)], "event_ts timestamp")
    silent = sorted(r["window_start"] for r in alerts.absence(df, 120).collect())
    assert silent == [_at(2), _at(4), _at(6)]
    steps = [(_at(m), v) for m, v in enumerate([5, 101, 150, 120, 99, 101, 102, 103, 104])]
    wdf = spark.createDataFrame(steps, "window_start timestamp, events long")
    held = sorted(r["window_start"] for r in alerts.held_above(wdf, 100, 3).collect())
    assert held == [_at(3), _at(7), _at(8)]


def test_failure_rate_must_hold(spark):
    rows = [(_at(m), "bad" if m in (10, 11, 12, 13, 20) else "ok") for m in range(30)]
    df = spark.createDataFrame(rows, "event_ts timestamp, event_type string")
    rates = alerts.failure_rate(df, ["bad"], ["ok"])
    hot = {r["window_start"] for r in alerts.rate_alert(rates).collect()}
    held = {r["window_start"] for r in alerts.rate_alert_held(rates).collect()}
    assert held == {t for t in hot if all(t - dt.timedelta(minutes=i) in hot for i in range(5))} and held and held < hot


def test_request_rate(spark):
    df = spark.createDataFrame([(_at(0), "home"), (_at(1), "home"), (_at(7), "cart")], "event_ts timestamp, page string")
    got = {(r["window_start"], r["page"]): (r["increase"], r["per_second"]) for r in alerts.request_rate(df).collect()}
    assert got == {(_at(0), "home"): (2, 2 / 300), (_at(5), "cart"): (1, 1 / 300)}


def test_silent_key_is_reported_once(spark, tmp_path):
    src = tmp_path / "in"
    _write(src, "a.json", [_event(0, 0), _event(1, 0), _event(3, 1)])  # U0, U1, U0
    _write(src, "b.json", [_event(4, 20), _event(7, 21)])  # only U1 goes on
    _write(src, "c.json", [_event(10, 40)])
    cleaned = jobs.clean_stream(jobs.read_event_stream(spark, str(src), max_files=1))
    _memory(alerts.absence_stream(cleaned, "user_id", gap_ms=5 * 60_000), "silent")
    got = sorted((r["user_id"], r["last_seen"]) for r in spark.table("silent").collect())
    # U0 is found by its timer; U1's silences by its own next events.
    assert got == [("U0", _at(1)), ("U1", _at(0)), ("U1", _at(21))]
