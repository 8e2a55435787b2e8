"""Quality rules over words and lines, with line frequency across the documents of a host.

Lines are normalised (words joined by one blank, A-Z in lower case) and hashed.
For each host the distinct documents that hold a line are counted, where equal
texts are one document: copies of a text do not make its lines boilerplate, they
are for a deduplication to judge.  A line in more documents than the limit, the
same for every host, is removed; a document that loses most of its words that
way is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, rows_of, text_of
from parcelight.session import cut_lineage

SYMBOLS = "#*$%&|<>"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACES = " \t\n\v\f\r"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of three words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    else:
        keys = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        _, inverse, counts = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
    again = counts[inverse.ravel()] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + n] |= again
    return int(covered.sum())


def text_measures(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, digest, line hashes, words of those lines in the text)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[bytes] = set()
    duplicates = 0
    found: dict[int, int] = {}
    for line in raw.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            duplicates += 1
        else:
            seen.add(line)
        key = xxhash.xxh3_64_intdigest(b" ".join(parts).translate(_LOWER)) - (1 << 63)
        found[key] = found.get(key, 0) + len(parts)
    return len(words), chars, symbols, duplicates, repeated_words(words), xxhash.xxh3_64_intdigest(raw) - (1 << 63), list(found), list(found.values())


_FIELDS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("__text_key", pa.int64()),
    ("__lines", pa.list_(pa.int64())),
    ("__line_words", pa.list_(pa.int64())),
]


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of each text, one row for each input row."""
    slim = docs.select("doc_id", F.col(host).cast("string").alias("__host"), text_of().alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in by_size(rows_of(iter([batch]), "doc_id", "__host", "__text"), lambda r: len(r[2]), 4_000_000):
                found = list(zip(*[text_measures(r[2]) for r in group], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in group], batch.schema.field("doc_id").type),
                        pa.array([r[1] for r in group], pa.string()),
                        *[pa.array(list(v), t) for v, (_, t) in zip(found, _FIELDS, strict=True)],
                    ],
                    ["doc_id", "__host", *[n for n, _ in _FIELDS]],
                )

    schema = (
        f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, __host string, n_words bigint, word_chars bigint, "
        "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, __text_key bigint, __lines array<bigint>, __line_words array<bigint>"
    )
    return slim.mapInArrow(run, schema)


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    least_words: int = 50,
    most_repeated: int = 50,
    least_documents: int = 25,
    least_left: float = 0.3,
) -> DataFrame:
    """Measures of every document, the base verdict and the verdict after boilerplate lines are gone.

    A line is boilerplate on its host when more than ``least_documents`` different
    texts hold it, however large the host is.  A document is depleted when less
    than ``least_left`` of its words is left.  One row for each input row; a null
    text has no words, a null host is a host of its own, and rows that repeat an
    id are documents of their own.
    """
    base = cut_lineage(measured(docs, host).withColumn("__row", F.monotonically_increasing_id()))
    lines = base.select("__row", "__host", "__text_key", F.explode(F.arrays_zip("__lines", "__line_words")).alias("__l")).select(
        "__row", "__host", "__text_key", F.col("__l.__lines").alias("__line"), F.col("__l.__line_words").alias("__n")
    )
    # a line of a hot host is spread over the texts that hold it before it is counted
    held = lines.select("__host", "__line", "__text_key").distinct().groupBy("__host", "__line").agg(F.count(F.lit(1)).alias("__docs"))
    common = held.where(F.col("__docs") > least_documents).select(F.col("__host").alias("__common_host"), F.col("__line").alias("__common"))
    removed = (
        lines.join(common, F.col("__host").eqNullSafe(F.col("__common_host")) & (F.col("__line") == F.col("__common")))
        .groupBy("__row")
        .agg(F.sum("__n").alias("__gone"), F.count(F.lit(1)).alias("__gone_lines"))
        .withColumnRenamed("__row", "__removed_row")
    )
    gone = F.coalesce(F.col("__gone"), F.lit(0))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    depleted = (gone > 0) & ((F.col("n_words") - gone) < least_left * F.col("n_words"))
    return base.join(removed, F.col("__row") == F.col("__removed_row"), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        gone.alias("n_boilerplate_words"),
        F.coalesce(F.col("__gone_lines"), F.lit(0)).alias("n_boilerplate_lines"),
        depleted.alias("depleted"),
    )
