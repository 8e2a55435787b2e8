"""What the text operators share: inputs, Arrow batches, small text helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.session import tuned

# White space of the word rule: blank and U+0009 to U+000D.  It is what
# ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"

# Rows in one Arrow batch, so that a worker holds a bounded piece of a partition.
ARROW_ROWS = 256


def prepared(spark: SparkSession) -> SparkSession:
    """Runtime settings for long texts; Python workers find this package where the driver does.

    A cluster gets the package by ``--py-files`` or an installation; there the
    added path does nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    tuned(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def text_of(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The rows under names that clash with no other, with ``__at``, their place in the read.

    The second value gives each column of ``docs`` under its own name again.  The
    place is the same in each read of a stored table.
    """
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.monotonically_increasing_id().alias("__at"))
    return inner, {c: F.col(n).alias(c) for c, n in names.items()}


def held_out(id_col: str = "doc_id") -> Column:
    """One fifth of the ids, chosen by checksum; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def by_size(items: Iterator, size, limit: int, at_most: int = 1 << 30) -> Iterator[list]:
    """Consecutive items in groups whose sizes add up to about ``limit``."""
    group, held = [], 0
    for item in items:
        group.append(item)
        held += size(item)
        if held >= limit or len(group) >= at_most:
            yield group
            group, held = [], 0
    if group:
        yield group


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Values of the named columns, row after row, a slice of a batch at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            yield from zip(*[part.column(n).to_pylist() for n in names], strict=True)

