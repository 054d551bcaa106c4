"""Time parts of epoch-millisecond values as built-in Column expressions.

All of these stay inside whole-stage codegen (no Python worker). Hour, month
and weekday follow ``spark.sql.session.timeZone``; the jobs run with UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60_000
MS_PER_DAY = 86_400_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_days(ms: Column | str) -> Column:
    """Whole days in a millisecond span (floor), as int."""
    return F.floor(_col(ms) / MS_PER_DAY).cast("int")


def to_minutes(ms: Column | str) -> Column:
    """Minutes of the span's time-of-day part, as int.

    Whole days are dropped first, so a 25 h span gives 60. This is the
    behaviour of a timedelta's ``seconds`` field, which the label keeps.
    """
    return F.floor(F.pmod(_col(ms), F.lit(MS_PER_DAY)) / MS_PER_MINUTE).cast("int")


def _instant(ms: Column | str) -> Column:
    # floor() also accepts the double produced by AVG(ts)
    return F.timestamp_millis(F.floor(_col(ms)))


def to_hour(ms: Column | str) -> Column:
    """Hour of day of an epoch-ms instant, as float."""
    return F.hour(_instant(ms)).cast("float")


def to_month(ms: Column | str) -> Column:
    """Month number (1-12) of an epoch-ms instant, year ignored, as float."""
    return F.month(_instant(ms)).cast("float")


def to_day(ms: Column | str) -> Column:
    """Weekday of an epoch-ms instant with Monday = 0, as float."""
    return F.weekday(_instant(ms)).cast("float")
