"""Stream tables: complete in any order of arrival, counted once after a restart, bounded by a time to live."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from eventloom.schema import EVENT_SCHEMA
from eventloom.streaming import jobs
from eventloom.streaming.live import FirstArrivals, LiveWindows

SHAPE = "event_id string, event_type string, event_ts timestamp, page string"
START = dt.datetime(2026, 7, 20)


def _rows(n=500):
    return [(f"e{i}", "purchase" if i % 4 == 0 else "view", START + dt.timedelta(minutes=7 * i), "home") for i in range(n)]


def _files(spark, tmp_path, parts):
    """One file per part, in this order of arrival."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SHAPE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{i:02d}"))
    return jobs.read_event_stream(spark, str(tmp_path / "in" / "*"), T.StructType.fromDDL(SHAPE), fmt="parquet", max_files=1)


def _newest_first(rows, parts=5):
    return [rows[len(rows) * i // parts : len(rows) * (i + 1) // parts] for i in reversed(range(parts))]


@pytest.mark.parametrize("slide", [None, "1 hour"])
def test_every_window_of_late_files(spark, tmp_path, slide):
    rows = _rows()
    live = LiveWindows(spark, str(tmp_path / "live"), "3 hours" if slide else "1 hour", slide)
    query = live.run(_files(spark, tmp_path, _newest_first(rows)), str(tmp_path / "chk"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 5
    batch = jobs.window_counts(spark.createDataFrame(rows, SHAPE), "3 hours" if slide else "1 hour", slide)
    want = sorted(map(tuple, batch.collect()))
    assert sorted(map(tuple, live.counts().collect())) == want and sum(r[2] for r in want) == 500 * (3 if slide else 1)
    # A repeated batch changes nothing, nor does folding batches, nor a merge that was not finished.
    live.update(spark.createDataFrame(_newest_first(rows)[2], SHAPE), 2)
    assert sorted(map(tuple, live.counts().collect())) == want
    live.merge(3)
    live.merge(3)
    spark.createDataFrame([(START, 99, 99)], live.table.schema).write.parquet(str(tmp_path / "live" / "merged" / "through=4"))
    assert sorted(map(tuple, live.counts().collect())) == want
    live.merge(4)
    assert sorted(map(tuple, live.counts().collect())) == want and live.table._read("rows", "batch_id").count() > len(want)


def test_restart_between_batches(spark, tmp_path):
    rows = _rows(100)
    first, second = rows[50:], rows[:50]
    live = LiveWindows(spark, str(tmp_path / "live"), "1 hour", keys=("page",))
    live.run(_files(spark, tmp_path, [first]), str(tmp_path / "chk")).awaitTermination()
    spark.createDataFrame(second, SHAPE).coalesce(1).write.parquet(str(tmp_path / "in" / "99"))
    again = LiveWindows(spark, str(tmp_path / "live"), "1 hour", keys=("page",))
    source = jobs.read_event_stream(spark, str(tmp_path / "in" / "*"), T.StructType.fromDDL(SHAPE), fmt="parquet", max_files=1)
    again.run(source, str(tmp_path / "chk")).awaitTermination()
    want = jobs.window_counts(spark.createDataFrame(rows, SHAPE), "1 hour", keys=("page",))
    assert sorted(map(tuple, again.counts().collect())) == sorted(map(tuple, want.collect()))


def test_first_arrivals_lose_nothing(spark, tmp_path):
    """Five files, newest first, each with copies of rows of another, and rows without a key."""
    rows = _rows()
    parts = _newest_first(rows)
    parts = [p + parts[(i + 2) % 5][:30] + p[:10] + [(None, "view", START, f"p{i}")] for i, p in enumerate(parts)]
    store = FirstArrivals(spark, str(tmp_path / "store"), T.StructType.fromDDL(SHAPE), buckets=4, pages=2)
    store.run(_files(spark, tmp_path, parts), str(tmp_path / "chk")).awaitTermination()
    got = [r["event_id"] for r in store.rows().collect()]
    assert sorted(x for x in got if x) == sorted(r[0] for r in rows) and got.count(None) == 5
    want = {"arrived": 705, "first": 505, "late": 0, "repeated": 200, "remembered": 500}
    assert store.report().first().asDict() == want
    # A batch that is tried again, and one that is all copies.
    store.update(spark.createDataFrame(parts[3], SHAPE), 3)
    assert store.report().first().asDict() == want
    store.merge(4)
    store.update(spark.createDataFrame(rows[::7], SHAPE), 5)
    assert store.report().first().asDict() == want | {"arrived": 705 + 72, "repeated": 272}
    assert sorted(x for x in (r["event_id"] for r in store.rows().collect()) if x) == sorted(r[0] for r in rows)


def test_time_to_live_bounds_the_store(spark, tmp_path):
    rows = _rows(300)
    store = FirstArrivals(spark, str(tmp_path / "store"), T.StructType.fromDDL(SHAPE), ttl="10 hours")
    for i in range(3):
        store.update(spark.createDataFrame(rows[100 * i : 100 * i + 100], SHAPE), i)
    store.merge(2)
    # 10 hours are 85 rows 7 minutes apart, and the newest itself.
    assert store.report().first()["remembered"] == 86
    late, on_time = rows[10], rows[290]
    store.update(spark.createDataFrame([late, on_time, ("new", "view", START, "home"), ("newer", "view", rows[299][2], "home"), ("timeless", "view", None, "x")], SHAPE), 3)
    assert sorted(r["event_id"] for r in store.late.read().collect()) == ["e10", "new"]
    report = store.report().first()
    assert (report["first"], report["late"], report["repeated"]) == (302, 2, 1)


def test_empty_batches(spark, tmp_path):
    store = FirstArrivals(spark, str(tmp_path / "store"), T.StructType.fromDDL(SHAPE), ttl="1 hour")
    live = LiveWindows(spark, str(tmp_path / "live"), "1 hour")
    for table in (store, live):
        table.update(spark.createDataFrame([], SHAPE), 0)
        table.merge(0)
    assert store.rows().count() == 0 and live.counts().count() == 0
    assert store.report().first().asDict() == {"arrived": 0, "first": 0, "late": 0, "repeated": 0, "remembered": 0}
