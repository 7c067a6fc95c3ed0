"""Time and rounding arithmetic that is exact and independent of the session time zone."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    # counting from year 1 keeps every difference positive, so truncation equals floor
    return F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")


def minute_index(ts: Column | str) -> Column:
    """Whole minutes from 0001-01-01 00:00 to ``ts`` (wall clock, no time zone involved)."""
    return F.timestamp_diff("MINUTE", _epoch(), _c(ts))


def micros_index(ts: Column | str) -> Column:
    """Whole microseconds from 0001-01-01 00:00 to ``ts``."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    00:00:59 -> 00:01:01 counts 1 (boundaries, not elapsed minutes), exactly as the
    difference of the two minute-truncated times.
    """
    return minute_index(end) - minute_index(start)


def ratio_percent(num: str, den: str, scale: int = 2) -> Column:
    """``100 * num / den`` rounded half-up to ``scale`` decimals, exact; 0.0 when ``den`` is
    zero or NULL (the report's guard)."""
    p = 10 ** scale
    return F.expr(
        f"CASE WHEN `{den}` > 0 THEN "
        f"CAST((CAST(`{num}` AS BIGINT) * {200 * p} + `{den}`) div (CAST(`{den}` AS BIGINT) * 2) AS DOUBLE) / {p}.0 "
        f"ELSE 0.0 END"
    )


def day_at_hour(d: date | datetime | str, hour: int = 0) -> datetime:
    """The timestamp of ``hour``:00 on day ``d`` (midnight by default). Clock values are
    parameters; this only builds them."""
    if isinstance(d, str):
        d = date.fromisoformat(d[:10])
    if isinstance(d, datetime):
        d = d.date()
    return datetime.combine(d, time(hour))


def ntz(ts: datetime | date | str) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so it never passes through a time zone."""
    if isinstance(ts, date) and not isinstance(ts, datetime):
        ts = datetime.combine(ts, time(0))
    text = ts.isoformat(sep=" ") if isinstance(ts, datetime) else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def date_lit(d: date | str) -> Column:
    return F.lit(d.isoformat() if isinstance(d, date) else str(d)).cast("date")
