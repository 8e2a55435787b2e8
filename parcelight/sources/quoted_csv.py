"""CSV files with line breaks in fields, read in byte ranges.

A line break ends a record only outside quotes, that is after an even number of
quote characters; a doubled quote in a field counts two and changes nothing.  So
the number of quotes in each byte range, summed over the ranges before it, says
whether a range begins inside a field.  With that every range finds its own
records.  Only the pieces of records that reach over a border are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.sources.readers import CSV_OPTIONS, typed_fields

_PIECES = "file string, block bigint, part int, first boolean, record string"


def _pieces(lines: DataFrame, inside) -> DataFrame:
    """Records that lie in one range (part 1), and the head (0) and tail (2) of a range that belong to longer ones.

    ``inside`` is a broadcast set of the ranges that begin inside a field.  A range
    that ends inside a field leaves its last record as a tail; a range that
    begins inside one starts with a head.
    """

    def joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
        offsets = pa.array(np.append(starts, len(lines)).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, odd, at_head, first, held = None, False, False, False, []

        def rows(records: pa.Array, parts: list[int], firsts: list[bool]) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array(parts, pa.int32()), pa.array(firsts, pa.bool_()), records.cast(pa.string())],
                ["file", "block", "part", "first", "record"],
            )

        def closed() -> Iterator[pa.RecordBatch]:
            """The open record of a range whose lines are all read."""
            if held:
                text = pa.array(["\n".join(held)])
                yield rows(text, [0 if at_head else 2 if odd else 1], [first and not at_head])

        for batch in batches:
            files, blocks = batch.column("file").to_numpy(False), batch.column("block").to_numpy(False)
            changes = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for begin, end in zip([0, *changes], [*changes, batch.num_rows], strict=True):
                if begin == end:
                    continue
                here = (files[begin], int(blocks[begin]))
                if here != at:
                    yield from closed()
                    at, held = here, []
                    odd = at_head = here in inside.value
                    first = here[1] == 0
                lines = batch.column("value").slice(begin, end - begin)
                quotes = pc.count_substring(lines, '"').to_numpy(False).astype(np.int64)
                after = (np.cumsum(quotes) + odd) % 2 == 1
                before = np.concatenate([[odd], after[:-1]])
                starts = np.flatnonzero(~before)
                odd = bool(after[-1])
                if not len(starts):
                    held += lines.to_pylist()
                    continue
                # lines before the first start belong to what is open, those from the last start on stay open
                if starts[0]:
                    held += lines.slice(0, int(starts[0])).to_pylist()
                if held:
                    yield rows(pa.array(["\n".join(held)]), [0 if at_head else 1], [first and not at_head])
                    first, at_head = first and at_head, False
                at_head = False
                last = int(starts[-1])
                if len(starts) > 1:
                    whole = joined(lines.slice(int(starts[0]), last - int(starts[0])), starts[:-1] - starts[0])
                    yield rows(whole, [1] * len(whole), [first] + [False] * (len(whole) - 1))
                    first = False
                held = lines.slice(last).to_pylist()
        yield from closed()

    return lines.mapInArrow(run, _PIECES)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record): the text of every record, and whether it is the first of its file.

    Quotes must stand around whole fields and be doubled inside them.  The ranges
    are those that Spark cuts files into, ``spark.sql.files.maxPartitionBytes``;
    the driver learns one flag of each, not of each row.  The number of quotes is
    counted in a pass of its own, without a shuffle of lines.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    )
    quotes = lines.groupBy("file", "block").agg((F.sum(F.regexp_count("value", F.lit('"'))) % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = quotes.select("file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    inside = spark.sparkContext.broadcast({(r["file"], r["block"]) for r in begins.where("inside").collect()})
    pieces = _pieces(lines, inside)
    # a tail opens a record, heads of the next ranges go on with it
    cut = pieces.where("part <> 1")
    numbered = cut.withColumn(
        "number", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "part"))
    )
    mended = (
        numbered.groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("block", "part", "record"))).alias("p"))
        .select("first", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    )
    return pieces.where("part = 1").select("first", "record").unionByName(mended)


def scan_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``readers.scan_csv`` reads, from files that are split: a large file is many tasks.

    Blank records are skipped, the first record of a file is its header.
    """
    as_text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header",)}
    body = csv_records(spark, path).where(~F.col("first") & (F.trim("record", F.lit(" \t\r\n")) != ""))
    parsed = body.select(F.from_csv(F.regexp_replace("record", "\r$", ""), as_text, options).alias("r")).select("r.*")
    return parsed.select(*typed_fields(schema))
