"""Models refreshed by day equal a full build, and days that did not change are not read."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from eventloom.plans import models
from eventloom.plans.refresh import DailyModels

SHAPE = "event_id string, user_id string, event_type string, product_id string, event_ts timestamp, page string, referrer string, duration_ms long, device string, browser string"
START = dt.datetime(2026, 7, 20)
D = [START.date() + dt.timedelta(days=i) for i in range(4)]


def _events(a, b, day):
    kinds = ("page_view", "purchase", "add_to_cart")
    return [
        (f"e{i}", None if i % 11 == 0 else f"u{i % 7}", kinds[i % 3], None if i % 5 == 0 else f"p{i % 4}", START + dt.timedelta(days=day, minutes=i),
         "home", None, None if i % 6 == 0 else i * 10, "mobile", "Firefox")
        for i in range(a, b)
    ]


def _stage(spark, rows, path, mode="append"):
    stg = models.stg_user_events(spark.createDataFrame(rows, SHAPE))
    stg.write.mode(mode).partitionBy("event_date").parquet(path)


def _tables(built):
    return [sorted(map(str, (r.asDict() for r in df.collect()))) for df in (built.dim_users(), built.dim_products(), built.fct_user_events_daily())]


def _full(spark, rows):
    stg = models.stg_user_events(spark.createDataFrame(rows, SHAPE))
    return [sorted(map(str, (r.asDict() for r in df.collect()))) for df in (models.dim_users(stg), models.dim_products(stg), models.fct_user_events_daily(stg))]


def test_appended_late_and_emptied_days(spark, tmp_path):
    stg, old = str(tmp_path / "stg"), [*_events(0, 60, 0), *_events(60, 100, 1), *_events(100, 130, 2)]
    _stage(spark, old, stg)
    built = DailyModels(spark, str(tmp_path / "m"))
    assert built.refresh(spark.read.parquet(stg), D[:3]) == D[:3]
    assert _tables(built) == _full(spark, old)
    # A new day, and late events of an old one. The first day's events are gone by now, so reading them would show.
    new = [*_events(130, 150, 3), *_events(150, 160, 1)]
    _stage(spark, new, stg)
    shutil.move(f"{stg}/event_date={D[0]}", str(tmp_path / "kept"))
    assert built.refresh(spark.read.parquet(stg), [D[3], D[1]]) == [D[1], D[3]]
    assert _tables(built) == _full(spark, old + new)
    assert built.refresh(spark.read.parquet(stg)) == []
    # A refresh of the first day now finds nothing there.
    built.refresh(spark.read.parquet(stg), [D[0]])
    assert _tables(built) == _full(spark, old[60:] + new)


@pytest.mark.parametrize("written", [0, 1, 2, 3])
def test_a_lost_refresh_is_made_again(spark, tmp_path, written):
    stg, rows = str(tmp_path / "stg"), [*_events(0, 60, 0), *_events(60, 100, 1)]
    _stage(spark, rows, stg)
    built = DailyModels(spark, str(tmp_path / "m"))
    built.refresh(spark.read.parquet(stg), D[:2])
    more = _events(100, 140, 1)
    _stage(spark, more, stg)
    lost = DailyModels(spark, str(tmp_path / "m"))
    states = lost._states

    def some(df):
        yield from list(states(df).items())[:written]
        raise RuntimeError("lost")

    lost._states = lambda df: type("Lost", (), {"items": lambda self: some(df)})()
    with pytest.raises(RuntimeError):
        lost.refresh(spark.read.parquet(stg), [D[1]])
    again = DailyModels(spark, str(tmp_path / "m"))
    assert again.pending() == [D[1]]
    assert again.refresh(spark.read.parquet(stg)) == [D[1]] and again.pending() == []
    assert _tables(again) == _full(spark, rows + more)


def test_the_filter_on_days_reaches_the_scan(spark, tmp_path):
    stg = str(tmp_path / "stg")
    _stage(spark, [*_events(0, 60, 0), *_events(60, 100, 1)], stg)
    state = DailyModels(spark, str(tmp_path / "m"))._states(spark.read.parquet(stg).filter(F.col("event_date").isin([D[1]])))
    for df in state.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [event_date" in plan or "event_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
