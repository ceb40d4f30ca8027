"""Time expressions.  All arithmetic is on ``us``, a long of microseconds since 1970."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 3600 * SECOND
DAY = 24 * HOUR

#: Fixed value: what a stamp looks like, the fraction being set off by a point.
STAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_PER_UNIT = {"seconds": SECOND, "minutes": MINUTE, "hours": HOUR, "days": DAY}
_SUFFIX = {"s": SECOND, "min": MINUTE, "m": MINUTE, "h": HOUR, "d": DAY}


def parse_stamp(raw: Column) -> Column:
    """Logger stamp ``2026-01-28 03:30:04 48`` (blank before the fraction) to TIMESTAMP_NTZ.

    A stamp that does not have date, time and at most a fraction, or is no instant, becomes NULL.
    """
    stamp = F.regexp_replace(F.trim(raw), r" (\d+)$", r".$1")
    return F.when(stamp.rlike(STAMP), stamp).try_cast("timestamp_ntz")


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, cast(`{ts}` as timestamp_ntz))")


def micros_of(stamp: str) -> Column:
    """Microseconds since 1970 of a literal stamp."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, timestamp_ntz'{stamp}')")


def to_stamp(us: Column) -> Column:
    """TIMESTAMP_NTZ from microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def plus_days(us: Column, days: Column) -> Column:
    """Microseconds ``days`` (possibly fractional) after ``us``."""
    return us + F.round(days * DAY).cast("long")


def span(us_from: Column, us_to: Column, unit: str = "hours") -> Column:
    """Duration between two instants in seconds, minutes, hours or days."""
    return (us_to - us_from).cast("double") / F.lit(float(_PER_UNIT[unit]))


def width(text: str) -> int:
    """Microseconds of a duration such as ``30min``, ``6h`` or ``7d``."""
    number = text.rstrip("abcdefghijklmnopqrstuvwxyz")
    return int(float(number) * _SUFFIX[text[len(number):]])


def day_of(us: Column) -> Column:
    """Whole days since 1970; negative stamps floor correctly."""
    return F.floor(us / F.lit(DAY)).cast("long")


def calendar_features(ts: Column) -> dict[str, Column]:
    """Hour, Monday-first weekday, day of month, weekend flag and the hour on a circle."""
    hour = F.hour(ts)
    angle = hour * F.lit(2.0) * F.pi() / F.lit(24.0)
    return {
        "hour": hour,
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
    }
