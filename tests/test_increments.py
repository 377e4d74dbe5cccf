"""Incremental loads: two increments and a broken run, each row once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.sources.increments import IncrementalLoad

SHAPE = "event_id string, event_ts timestamp"
START = dt.datetime(2026, 7, 20)


def _rows(a, b):
    return [(f"e{i}", START + dt.timedelta(minutes=i)) for i in range(a, b)]


@pytest.mark.parametrize("lost", ["before rows", "after rows"])
def test_a_lost_run_is_made_again(spark, tmp_path, lost):
    frame = lambda a, b: spark.createDataFrame(_rows(a, b) + [("timeless", None)], SHAPE)
    schema = frame(0, 1).schema
    load = IncrementalLoad(spark, str(tmp_path / "t"), schema)
    assert load.run(frame(0, 10)) == 10 and load.run(frame(0, 10)) == 0

    def fail(*_):
        raise RuntimeError("lost")

    broken = IncrementalLoad(spark, str(tmp_path / "t"), schema)
    if lost == "before rows":
        broken.loaded.put = fail
    else:
        broken.commits.put = fail
    with pytest.raises(RuntimeError):
        broken.run(frame(0, 15))
    assert load.rows().count() == 10
    # By now the source has more: the lost increment keeps its times, the rest comes with the next.
    again = IncrementalLoad(spark, str(tmp_path / "t"), schema)
    assert again.run(frame(0, 30)) == 5 and again.run(frame(0, 30)) == 15
    assert sorted(r["event_id"] for r in again.rows().collect()) == sorted(r[0] for r in _rows(0, 30))
    assert again.mark().first().asDict() == {"mark": START + dt.timedelta(minutes=29), "increments": 3, "rows": 30}


def test_empty_source(spark, tmp_path):
    empty = spark.createDataFrame([], SHAPE)
    load = IncrementalLoad(spark, str(tmp_path / "t"), empty.schema)
    assert load.run(empty) == 0 and load.rows().count() == 0
    assert load.mark().first().asDict() == {"mark": None, "increments": 0, "rows": 0}
