"""Repeatable samples and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, or all of them if there are fewer.

    The digest of seed and key decides, so the choice depends neither on the
    partitioning nor on the row order; every task keeps only its best ``n``.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(draw, F.col(key)).limit(n)


def top_rows(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows; the last sort column must make the order unique."""
    return df.orderBy(*order_by).limit(n)
