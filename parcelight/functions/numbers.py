"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round by ``floor(x * 10^d + 0.5) / 10^d``, the same on every engine."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale


def money_sum(value: Column) -> Column:
    """Sum of amounts that does not depend on the order of rows, to be rounded at its end.

    Whole units and millionths are summed apart as whole numbers, which add up
    the same in any order; a plain sum of doubles does not, and with enough rows
    that reaches the second decimal.  An amount counts to its sixth decimal.  Null
    and NaN count nothing; no amount at all gives null.
    """
    whole = F.floor(value)
    millionths = F.floor((value - whole) * 1_000_000.0 + 0.5)
    return F.sum(whole) + F.sum(millionths) / F.lit(1_000_000.0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is null where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def clip(value: Column, low: int, high: int) -> Column:
    """Limit to ``low..high``; null stays null."""
    return F.when(value.isNull(), value).otherwise(
        F.greatest(F.least(value, F.lit(high)), F.lit(low))
    )


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage of ``part`` in ``whole``; 0 for an empty whole."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))
