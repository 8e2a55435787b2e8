"""Timestamp column expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels of the what-if form, Monday is 0.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def whole_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, cut toward zero."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def floor_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down (so -1 hour is -1 day)."""
    gap = end - start
    days = whole_days(start, end)
    return days - (F.make_dt_interval(days) > gap).cast("int")


def weekday_number(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def weekday_from_label(label: Column) -> Column:
    """``Mon`` .. ``Sun`` to 0 .. 6; anything else is null."""
    position = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), label)
    return F.when(position > 0, (position - 1).cast("int"))


def on_days(ts: Column, first: date | None, last: date | None) -> Column:
    """Inclusive range on the date part, kept as a plain comparison on the
    column so that it reaches the scan.  Both ends must be given to filter."""
    if first is None or last is None:
        return F.lit(True)
    after = F.lit((last + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return (ts >= F.lit(first.isoformat()).cast("timestamp_ntz")) & (ts < after)


def is_late(delivered: Column, promised: Column) -> Column:
    """1 when delivered after the promise, 0 otherwise and where unknown."""
    return F.when(delivered > promised, 1).otherwise(0)
