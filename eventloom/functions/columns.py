"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from eventloom.schema import TIMESTAMP_FORMATS

SECONDS_PER_DAY = 86_400

# The texts that the default timestamp formats accept, as one pattern.
ISO_EVENT_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{6}(Z|[+-]\d{2}:\d{2})|Z|[+-]\d{2}:\d{2})?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; null stays null (``least``/``greatest`` alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def parse_event_ts(c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First accepted timestamp form, else null. Never throws under ANSI mode.

    The default forms are all ISO, so one pattern decides whether a text is accepted and Spark's
    own cast reads it. Trying formats in turn costs an exception per row and failed format.
    """
    c = _col(c)
    if tuple(formats) == TIMESTAMP_FORMATS:
        return F.when(c.rlike(ISO_EVENT_TIME), F.try_to_timestamp(c))
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def lenient_ts(c: Column | str) -> Column:
    """Any timestamp text Spark can cast, else null."""
    return F.try_to_timestamp(_col(c))


def epoch_seconds(c: Column | str) -> Column:
    """Unix seconds of a timestamp; 0 when missing."""
    return F.coalesce(F.unix_timestamp(_col(c)), F.lit(0))


def days_since(c: Column | str, as_of: Column, whole: bool = False) -> Column:
    """Days from ``c`` to ``as_of`` as a fraction, or truncated when ``whole``."""
    seconds = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(_col(c).cast("timestamp"))
    days = seconds / F.lit(SECONDS_PER_DAY)
    return days.cast("long") if whole else days


def tier(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first descending cut that ``c`` reaches; the last label is the rest."""
    c = _col(c)
    if len(labels) != len(cuts) + 1:
        raise ValueError("tier needs one label more than cuts")
    chain = F.when(c >= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        chain = chain.when(c >= cut, label)
    return chain.otherwise(labels[-1])


def finite_or(c: Column | str, nan: float, posinf: float, neginf: float) -> Column:
    """Replace null/NaN and the two infinities by constants."""
    c = _col(c).cast("double")
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(float(nan)))
        .when(c == F.lit(float("inf")), F.lit(float(posinf)))
        .when(c == F.lit(float("-inf")), F.lit(float(neginf)))
        .otherwise(c)
    )


def rate_pct(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as % of ``whole``, rounded half up in decimal; null when whole is 0."""
    exact = part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))
    return F.round(exact, digits).cast("double")
