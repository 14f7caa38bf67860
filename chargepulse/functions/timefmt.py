"""Time helpers for digit-string stamps (FN2, FN6, PRJ4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prefix(col, n: int) -> Column:
    """First ``n`` characters: day 8 / hour 10 / minute 12 of a compact stamp,
    month 7 / day 10 of an ISO date string."""
    return F.substring(_c(col), 1, n)


def compact_ts_millis(col) -> Column:
    """``yyyyMMddHHmmssSSS`` (extra trailing digits ignored) -> epoch millis.

    Spark's datetime parser rejects the adjacent ``ssSSS`` fields, so the
    seconds-resolution part is parsed and the three millisecond digits added.
    Malformed input gives NULL (``try_`` forms; ANSI mode stays on).
    """
    c = _c(col)
    secs = F.try_to_timestamp(F.substring(c, 1, 14), F.lit("yyyyMMddHHmmss"))
    frac = F.when(F.substring(c, 15, 3).rlike("^[0-9]{3}$"),
                  F.substring(c, 15, 3).cast("bigint"))
    return F.unix_millis(secs) + frac


def duration_ms(start_col, end_col) -> Column:
    """``end - start`` in milliseconds, both compact stamps (FN6/PRJ6)."""
    return compact_ts_millis(end_col) - compact_ts_millis(start_col)
