"""Quality classifier: ordinal regression with cumulative links over hashed text.

One weight vector over hashed words and binned text shapes gives a position on
the quality scale; ordered thresholds cut the scale into grades:
P(grade >= k) = sigmoid(position - threshold_k).  The expected grade and the tail
probability of a grade serve for selection.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, held_out, rows_of, text_of

_CACHED_WORDS = 300_000
_WORD_SCALE = 4.0
_CLASSES = np.zeros(256, np.int64)  # of bytes: 1 capital, 2 symbol, 3 digit, 4 white space, 5 punctuation
_CLASSES[65:91], _CLASSES[48:58] = 1, 3
_CLASSES[list(b"#*$%&|<>{}[]\\^~=+@_")] = 2
_CLASSES[list(b" \t\n\v\f\r")] = 4
_CLASSES[list(b".,;:!?'\"()-")] = 5


def _bin(name: str, value: float) -> bytes:
    return f"\0{name}={value:.0f}".encode()


def shapes(raw: bytes, words: list[bytes]) -> list[bytes]:
    """Binned properties of a text, as extra words of it."""
    counts = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=6)
    size, n = max(len(raw) - counts[4], 1), max(len(words), 1)
    lines = raw.split(b"\n")
    filled = [x for x in lines if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        _bin("length", np.log2(n)),
        _bin("capitals", 10 * counts[1] / size),
        _bin("symbols", min(20, 40 * counts[2] / size)),
        _bin("digits", 10 * counts[3] / size),
        _bin("marks", min(20, 40 * counts[5] / size)),
        _bin("distinct", 10 * len(set(words)) / n),
        _bin("runs", 10 * same / n),
        _bin("lines", 10 * len(set(filled)) / max(len(filled), 1)),
        _bin("wordsize", min(20, size / n)),
    ]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def tails(self, position: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades - 1, a column each."""
        return 1 / (1 + np.exp(-np.clip(position[:, None] - self.thresholds[None, :], -30, 30)))


class Places:
    """Hash place of the words met so far; begins anew when it holds too many."""

    def __init__(self, buckets: int):
        self.mask, self.known = buckets - 1, {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > _CACHED_WORDS:
            self.known = {}
        known, mask = self.known, self.mask
        for w in set(words).difference(known):
            known[w] = zlib.crc32(w.lower().strip(b".,;:!?\"'()")) & mask
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def features(text: str, places: Places) -> tuple[np.ndarray, np.ndarray]:
    """Places and shares: every word weighs the same, every shape weighs one."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    at = places.of(words)
    extra = places.of(shapes(raw, words))
    share = np.concatenate([np.full(len(at), _WORD_SCALE / max(len(at), 1)), np.ones(len(extra))])
    return np.concatenate([at, extra]), share


def fit_ordinal(
    texts: list[str], grades: np.ndarray, weights: np.ndarray, n_grades: int, buckets: int = 1 << 16, epochs: int = 12, seed: int = 5
) -> OrdinalModel:
    """Maximum likelihood by Adagrad steps on small batches; ``weights`` undo a sample's class shares."""
    places = Places(buckets)
    rows = [features(t, places) for t in texts]
    w = np.zeros(buckets)
    shares = np.array([np.average(grades >= k, weights=weights) if len(grades) else 0.5 for k in range(1, n_grades)])
    shares = np.clip(shares, 1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(-np.log(shares / (1 - shares)) + 1e-3 * np.arange(n_grades - 1))
    square, square_cut = np.full(buckets, 1e-6), np.full(n_grades - 1, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            sizes = np.array([len(rows[i][0]) for i in batch])
            flat = np.concatenate([rows[i][0] for i in batch])
            share = np.concatenate([rows[i][1] for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            position = np.add.reduceat(w[flat] * share, starts)
            s = np.hstack([np.ones((len(batch), 1)), OrdinalModel(w, cuts).tails(position), np.zeros((len(batch), 1))])
            y, rows_at = grades[batch], np.arange(len(batch))
            low, high = s[rows_at, y], s[rows_at, y + 1]
            p = np.maximum(low - high, 1e-9)
            d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
            scale = weights[batch] / len(batch)
            g_cut = np.zeros(n_grades + 1)
            np.add.at(g_cut, y, d_low * scale)
            np.add.at(g_cut, y + 1, -d_high * scale)
            g_cut = g_cut[1:n_grades]
            g = np.bincount(flat, np.repeat((d_high - d_low) * scale, sizes) * share, buckets)
            touched = np.flatnonzero(g)
            square[touched] += g[touched] ** 2
            w[touched] -= 0.15 * (g[touched] / np.sqrt(square[touched]) + 1e-3 * w[touched])
            square_cut += g_cut**2
            cuts = np.maximum.accumulate(cuts - 0.05 * g_cut / np.sqrt(square_cut))
    return OrdinalModel(w.astype(np.float32), cuts)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade 0 (junk), 1 (readable but toxic) or 2 (readable and clean), from the two labels."""
    quality, toxic = F.col("quality").cast("int"), F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    return labels.select("doc_id", F.when(quality == 1, 2 - (toxic == 1).cast("int")).otherwise(quality).alias("grade"))


def train_quality(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, rows: int = 4500, **options) -> OrdinalModel:
    """Model from at most ``rows`` rated rows, the documented bound of the sample, none of the held-out fifth.

    Rows are chosen by digest of their id, as many of each grade where there are
    enough.  Rows without id or grade are left out; without any row every
    document gets even odds.
    """
    ours = (
        ratings.select(F.col("doc_id").alias("__id"), F.col("grade").cast("int").alias("__y"))
        .where(F.col("__id").isNotNull() & F.col("__y").between(0, n_grades - 1))
        .where(~held_out("__id"))
        .groupBy("__id")
        .agg(F.min("__y").alias("__y"))
    )
    totals = {r["__y"]: r["n"] for r in ours.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a grade
    digest = F.md5(F.concat(F.lit("rated:"), F.col("__id").cast("string")))
    chosen = None
    for k in range(n_grades):
        part = ours.where(F.col("__y") == k).orderBy(digest, "__id").limit(rows // n_grades)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = (
        docs.select(F.col("doc_id").alias("__doc"), text_of().alias("__text"))
        .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))  # at most ``rows`` rows
        .select("__doc", "__text", "__y")
        .collect()
    )
    found = sorted(map(tuple, found), key=lambda r: (str(r[0]), r[1]))
    y = np.array([r[2] for r in found], np.int64)
    have = np.bincount(y, minlength=n_grades)
    whole = sum(totals.values()) or 1
    weight = np.array([totals.get(k, 0) / whole / max(have[k] / max(len(y), 1), 1e-9) for k in range(n_grades)])
    return fit_ordinal([r[1] for r in found], y, weight[y], n_grades, **options)


def grade_documents(docs: DataFrame, model: OrdinalModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with expected_grade and tails, an array of P(grade >= k) for k = 1, 2, ..

    One row for each input row; a null text is empty and is judged by its shape.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    names = [f"__k{i}" for i in range(len(keep))]
    slim = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], text_of().alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        places = Places(len(m.weights))
        for batch in batches:
            position = np.empty(batch.num_rows)
            at = 0
            for group in by_size(rows_of(iter([batch]), "__text"), lambda r: len(r[0]), 4_000_000):
                for (text,) in group:
                    where, share = features(text, places)
                    position[at] = m.weights[where] @ share
                    at += 1
            tails = m.tails(position)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                [*names, "expected_grade", "tails"],
            )

    schema = ", ".join([*[f"{n} {slim.schema[n].dataType.simpleString()}" for n in names], "expected_grade double, tails array<double>"])
    return slim.mapInArrow(run, schema).select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "expected_grade", "tails"
    )


def tail(k: int) -> Column:
    """P(grade >= k)."""
    return F.col("tails")[k - 1]


def quality_grades(docs: DataFrame, labels: DataFrame, least_grade: int = 1, least_probability: float = 0.5) -> DataFrame:
    """doc_id, held_out, expected grade, tail probability of ``least_grade`` and the selection."""
    scored = grade_documents(docs, train_quality(docs, graded(labels)))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "expected_grade",
        tail(least_grade).alias("tail_probability"),
        (tail(least_grade) >= least_probability).alias("kept"),
    )
