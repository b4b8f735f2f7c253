"""Date and time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formats of the result tables and the archive -------------
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -----------------------------------------------------------------------------


def date_text(c: Column) -> Column:
    """``yyyy-MM-dd`` text of a date or timestamp."""
    return F.date_format(c, DATE_FORMAT)


def timestamp_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp."""
    return F.date_format(c, TIMESTAMP_FORMAT)


def date_prefix(c: Column) -> Column:
    """Date that a timestamp text starts with, padded or not, else NULL."""
    return F.try_to_date(F.regexp_extract(c, r"^\d{4}-\d{1,2}-\d{1,2}", 0), "yyyy-M-d")


def lenient_date(c: Column) -> Column:
    """Date that a text starts with, where month and day may lie out of range.

    They carry over: month 13 is January of the next year, day 0 the last day of the
    month before. NULL if the text does not start with three numbers joined by ``-``.
    """
    year, month, day = (F.try_to_number(F.nullif(
        F.regexp_extract(c, r"^(\d{1,4})-(\d{1,5})-(\d{1,5})", n), F.lit("")), F.lit("99999"))
        .cast("int") for n in (1, 2, 3))
    first = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    return F.date_add(first, day - 1)


def ingest_day(ts: Column) -> Column:
    """Day a message belongs to (P8), in the session time zone."""
    return F.to_date(ts)


def ms_to_next_midnight(ts: Column) -> Column:
    """Milliseconds from ``ts`` to the next midnight.

    Both instants are taken in whole milliseconds first (the difference of
    two millisecond clocks, as the reference computes it). Works on TIMESTAMP
    (midnight of the session time zone) and TIMESTAMP_NTZ alike.
    """
    day_start = F.date_trunc("DAY", ts)
    next_midnight = day_start + F.expr("INTERVAL 1 DAY")
    day_ms = F.timestamp_diff("MILLISECOND", day_start, next_midnight)
    elapsed_us = F.timestamp_diff("MICROSECOND", day_start, ts)
    return day_ms - F.floor(elapsed_us / F.lit(1000)).cast("bigint")


def epoch_millis_of_day(d: Column) -> Column:
    """Epoch milliseconds of the session time zone's midnight at the start of date ``d``."""
    return F.unix_millis(d.cast("timestamp"))


def local_clock(ts: Column) -> Column:
    """The session zone's wall clock at ``ts``, as an instant that reads the same in UTC.

    Windows are cut at UTC midnight; on this column they are local days in any
    zone, also in one that moves its clocks.
    """
    return F.from_utc_timestamp(ts, F.current_timezone())


def window_day(start: Column) -> Column:
    """The local day of a one-day window over :func:`local_clock`."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(start) / F.lit(86_400)).cast("int"))
