"""Bounded runs over stored records."""

import json

from pyspark.sql import functions as F

from eventloom.schema import RECORD_SCHEMA
from eventloom.sources.records import encode_records
from eventloom.sources import stored
from eventloom.sources.stored import RecordLog, share


def _records(spark, path, n, first=0):
    rows = spark.range(first, first + n).select(F.col("id").cast("string").alias("event_id"), F.lit("view").alias("event_type"))
    no = F.col("key").cast("string").cast("long")
    log = encode_records(rows).withColumns({"partition": (no % 3).cast("int"), "offset": F.floor(no / 3).cast("long"), "timestamp": F.lit("2026-07-20").cast("timestamp")})
    log.select(*RECORD_SCHEMA.names).repartition(4).write.mode("append").parquet(path)


def test_share():
    assert share({"0": 5, "1": 1, "2": 9}, 10) == {"0": 5, "1": 1, "2": 4}
    assert share({"0": 5, "1": 5, "2": 5}, 5) == {"0": 2, "1": 2, "2": 1}
    assert share({"2": 9, "10": 9}, 3) == {"2": 2, "10": 1}
    assert share({"0": 1}, 5) == {"0": 1} and share({}, 5) == {} and share({"0": 3}, 0) == {"0": 0}


def test_stop_after_and_resume(spark, tmp_path):
    source = str(tmp_path / "log")
    _records(spark, source, 100)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    ids = lambda: sorted(int(r["event_id"]) for r in log.events().collect())
    assert log.consume(stop_after=10, per_batch=4) == 10 and ids() == list(range(10))
    assert log.rows.read().select("offset").count() == 10
    assert log.consume(stop_after=0) == 0
    again = RecordLog(spark, source, str(tmp_path / "out"))
    assert again.consume(stop_after=31) == 31
    # Turns begin anew with each run: 4 + 11, 3 + 10 and 3 + 10 records.
    assert ids() == sorted([*range(0, 45, 3), *range(1, 39, 3), *range(2, 39, 3)])
    _records(spark, source, 20, first=100)
    assert again.consume(per_batch=50) == 79 and ids() == list(range(120))
    assert again.consume() == 0 and again.taken() == 120


def test_a_batch_that_broke_off_is_made_again(spark, tmp_path):
    source = str(tmp_path / "log")
    _records(spark, source, 60)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    put, tries = log._put, []

    def broken(batch, batch_id):
        tries.append(batch_id)
        put(batch, batch_id)
        if batch_id == 1 and tries.count(1) == 1:
            raise RuntimeError("lost")

    log._put = broken
    try:
        log.consume(per_batch=20)
        raise AssertionError("the failure should surface")
    except AssertionError:
        raise
    except Exception as error:  # what the stream ends with
        assert "lost" in str(error)
    assert log.consume(per_batch=20) == 20 and tries == [0, 1, 1, 2]
    assert sorted(int(r["event_id"]) for r in log.events().collect()) == list(range(60))


def test_a_batch_opens_the_files_of_its_offsets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "FILE_ROWS", 25)
    source = str(tmp_path / "log")
    _records(spark, source, 100)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    start, target = {"0": 2, "1": 0, "2": 5}, {"0": 30, "1": 33, "2": 33}
    held = log._in_order(start, target)
    options = {"path": source, "perBatch": "9", "start": json.dumps(start), "target": json.dumps(target), "ordered": json.dumps(held)}
    reader, at, seen = stored.StoredRecordReader(options), start, []
    while (end := reader.latestOffset()) != at:
        (task,) = reader.partitions(at, end)
        assert all(source not in r.files and len(r.files) <= 2 for r in task.ranges)
        seen += [(r["partition"], r["offset"]) for batch in reader.read(task) for r in batch.to_pylist()]
        at = dict(end)
    assert sorted(seen) == [(int(p), o) for p in start for o in range(start[p], target[p])]
    # Offsets outside of the run are still found.
    (task,) = reader.partitions({"0": 0, "1": 33, "2": 33}, {"0": 34, "1": 33, "2": 33})
    assert [r.files for r in task.ranges if r.end > r.start] == [[source]]
    assert sum(b.num_rows for b in reader.read(task)) == 34


def test_a_run_of_many_batches_reads_the_folder_once(spark, tmp_path):
    source = str(tmp_path / "log")
    _records(spark, source, 60)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    put = log._put

    def and_spoil(batch, batch_id):
        put(batch, batch_id)
        (tmp_path / "log" / "late.parquet").write_text("not a Parquet file")

    log._put = and_spoil
    assert log.consume(per_batch=20) == 60
    assert sorted(int(r["event_id"]) for r in log.events().collect()) == list(range(60))
    want = [(p, n, r) for ends, rows in (((7, 7, 6), (7, 7, 6)), ((14, 14, 12), (7, 7, 6)), ((20, 20, 20), (6, 6, 8))) for p, n, r in zip(range(3), ends, rows)]
    assert sorted(map(tuple, log.offsets.read().collect())) == sorted(want)


def test_a_trigger_of_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "FILE_ROWS", 25)
    source = str(tmp_path / "log")
    _records(spark, source, 100)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    start, target = {"0": 2, "1": 30, "2": 5}, {"0": 30, "1": 33, "2": 33}
    held = log._in_order(start, target)
    alone = {"path": source, "perBatch": "7", "start": json.dumps(start), "target": json.dumps(target), "ordered": json.dumps(held)}
    one, at, want, batch = stored.StoredRecordReader(alone), start, [], 5
    while (end := one.latestOffset()) != at:
        want += [(batch, int(p), o) for p in end for o in range(at[p], end[p])]
        at, batch = end, batch + 1
    for shared, most in ((40_000, 1_000_000), (10, 1_000_000), (3, 2)):
        monkeypatch.setattr(stored, "SHARED_OFFSETS", shared)
        monkeypatch.setattr(stored, "TASK_OFFSETS", most)
        reader = stored.StoredRecordReader(alone | {"number": "5", "together": "4"})
        at, seen, ends = start, [], []
        while (end := reader.latestOffset()) != at:
            tasks = reader.partitions(at, end)
            assert shared == 3 or all(len({i for i, t in enumerate(tasks) for r in t.ranges if r.batch == b}) == 1 for b in range(end["number"], reader.number))
            seen += [(r["batch_id"], r["partition"], r["offset"]) for t in tasks for b in reader.read(t) for r in b.to_pylist()]
            ends.append((at, end))
            at = end
        assert sorted(seen) == sorted(want) and len(ends) == 3
        # Made again by a run that began later, with other batches, a trigger has the batches it had.
        later = stored.StoredRecordReader({"path": source, "perBatch": "3", "start": json.dumps(target), "target": json.dumps(target), "number": "6"})
        again = [(r["batch_id"], r["partition"], r["offset"]) for t in later.partitions(*ends[0]) for b in later.read(t) for r in b.to_pylist()]
        assert sorted(again) == sorted(w for w in want if w[0] < 9) and later.number == 9
        # One that was begun before batches were numbered takes a number, too.
        assert later.partitions({"0": 0}, {"0": 1}) and later.number == 10


def test_a_run_takes_many_batches_in_few_triggers(spark, tmp_path):
    source = str(tmp_path / "log")
    _records(spark, source, 60)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    assert log.consume(per_batch=3) == 60
    assert len([f for f in (tmp_path / "out" / "checkpoint" / "commits").iterdir() if f.name.isdigit()]) == 1
    got = sorted((r["batch_id"], r["partition"], r["offset"]) for r in log.rows.batches().collect())
    assert got == [(b, p, b) for b in range(20) for p in range(3)]
    assert sorted(map(tuple, log.offsets.read().collect())) == sorted((p, b + 1, 1) for b in range(20) for p in range(3))


def test_a_trigger_that_broke_off_goes_on_with_its_own_batches(spark, tmp_path):
    source = str(tmp_path / "log")
    _records(spark, source, 60)
    log = RecordLog(spark, source, str(tmp_path / "out"))
    put, tries = log._put, []
    for lost in (0, 3):

        def broken(batch, batch_id, lost=lost):
            tries.append(batch_id)
            put(batch, batch_id)
            if batch_id == lost:
                raise RuntimeError("lost")

        log._put = broken
        try:
            log.consume(per_batch=12)
            raise AssertionError("the failure should surface")
        except AssertionError:
            raise
        except Exception as error:  # what the stream ends with
            assert "lost" in str(error)
    log._put = lambda batch, batch_id: (tries.append(batch_id), put(batch, batch_id))
    _records(spark, source, 20, first=60)
    assert log.taken() == 48 and log.consume(per_batch=15) == 32
    assert tries == [0, 0, 1, 2, 3, 3, 4, 5, 6]
    assert sorted(int(r["event_id"]) for r in log.events().collect()) == list(range(80))
    sizes = {r["batch_id"]: r["count"] for r in log.rows.batches().groupBy("batch_id").count().collect()}
    assert sizes == {**dict.fromkeys(range(5), 12), 5: 15, 6: 5}
    assert sum(r["rows"] for r in log.offsets.read().collect()) == 80
