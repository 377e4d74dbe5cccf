"""Alert conditions over time windows.

The windowed forms run on batch and streaming frames; ``absence`` and ``held_above`` look at
windows without rows or across windows and are batch jobs over the window table, with
``absence_stream`` as the stateful counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def failure_rate(
    df: DataFrame,
    bad: Sequence[str],
    good: Sequence[str],
    size: str = "5 minutes",
    slide: str = "1 minute",
    keys: Sequence[str] = (),
    ts: str = "event_ts",
    watermark: str | None = None,
) -> DataFrame:
    """Failures, total and failure share per sliding window.

    Events collapse to one row per ``slide`` before they are spread over overlapping windows.
    """
    kind = F.col("event_type")
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    counted = (
        df.filter(kind.isin(*bad, *good))
        .groupBy(F.window(ts, slide).alias("window"), *keys)
        .agg(F.count_if(kind.isin(*bad)).alias("failures"), F.count("*").alias("total"))
        .groupBy(F.window("window", size, slide).alias("window"), *keys)
        .agg(F.sum("failures").alias("failures"), F.sum("total").alias("total"))
    )
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
        "failures", "total", (F.col("failures") / F.col("total")).alias("failure_rate"),
    )


def rate_alert(rates: DataFrame, limit: float = 0.3) -> DataFrame:
    return rates.filter(F.col("failure_rate") > limit)


def _floor_to(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds) * seconds


# Windows that one row of the spine stands for before it is unfolded.
SPINE_RUN = 10_000


def absence(df: DataFrame, size_seconds: int = 120, where: Column | None = None, ts: str = "event_ts") -> DataFrame:
    """Windows between the first and the last event in which no (matching) event was seen.

    The spine of windows comes from the two ends of the time range; its length depends on the
    range and the window size, not on the number of events. It is built a run of windows at a time.
    """
    run = SPINE_RUN * size_seconds
    ends = df.agg(_floor_to(F.min(ts), size_seconds).alias("lo"), _floor_to(F.max(ts), size_seconds).alias("hi"))
    runs = ends.select("hi", F.explode(F.sequence("lo", "hi", F.lit(run))).alias("r"))
    last = F.least(F.col("hi"), F.col("r") + (run - size_seconds))
    spine = runs.select(F.explode(F.sequence("r", last, F.lit(size_seconds))).alias("w"))
    beats = df if where is None else df.filter(where)
    seen = beats.filter(F.col(ts).isNotNull()).select(_floor_to(F.col(ts), size_seconds).alias("w")).distinct()
    return spine.join(seen, "w", "left_anti").select(
        F.timestamp_seconds("w").alias("window_start"), F.timestamp_seconds(F.col("w") + size_seconds).alias("window_end")
    )


def held_above(
    df: DataFrame, limit: float, hold: int, step_seconds: int = 60, keys: Sequence[str] = (), ts: str = "window_start", value: str = "events"
) -> DataFrame:
    """Times at which ``value`` has been above ``limit`` for ``hold`` consecutive steps.

    Takes one row per step (and key). Each step above the limit vouches for the ``hold`` times
    that look back over it; a time is reported when all its steps vouch for it. That is a plain
    aggregation, spread over time and key, where a window per key would sit in one task.
    """
    above = df.filter(F.col(value) > limit).select(*keys, _floor_to(F.col(ts), step_seconds).alias("w"))
    looks = above.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(hold - 1))).alias("i"), "w")
    return (
        looks.groupBy(*keys, (F.col("w") + F.col("i") * step_seconds).alias("at"))
        .agg(F.count("*").alias("steps"))
        .filter(F.col("steps") == hold)
        .select(*keys, F.timestamp_seconds("at").alias("window_start"))
    )


def rate_alert_held(rates: DataFrame, limit: float = 0.3, minutes: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Times at which the failure share of each of the last ``minutes`` one-minute steps was above ``limit``.

    Takes the windows of ``failure_rate`` with a slide of one minute; a minute without events ends a hold.
    """
    return held_above(rates, limit, minutes, 60, keys, value="failure_rate")


def request_rate(df: DataFrame, size_seconds: int = 300, keys: Sequence[str] = ("page",), ts: str = "event_ts") -> DataFrame:
    """Increase per window and its rate per second, by key."""
    counted = df.groupBy(F.window(ts, f"{size_seconds} seconds").alias("window"), *keys).agg(F.count("*").alias("increase"))
    return counted.select(
        F.col("window.start").alias("window_start"), *keys, "increase", (F.col("increase") / F.lit(float(size_seconds))).alias("per_second")
    )


def absence_stream(sdf: DataFrame, key: str, gap_ms: int, delay: str = "1 minute", ts: str = "event_ts") -> DataFrame:
    """One row per silence: a key not seen for ``gap_ms`` of event time after its last event.

    Events of a key less than the gap apart are one session, which ends the gap after its last event and is given out
    when the watermark passes that end. State is one session per key and gap, merged map-side; no Python is involved.
    """
    sessions = sdf.withWatermark(ts, delay).groupBy(key, F.session_window(ts, f"{gap_ms} milliseconds").alias("session")).agg(F.count("*").alias("events"))
    return sessions.select(key, (F.col("session.end") - F.make_dt_interval(secs=F.lit(gap_ms / 1000))).alias("last_seen"))
