"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the mean of hashed embeddings of the word and of its leading
and inner character n-grams.  Filters of several widths slide over the words,
each filter keeps its largest response (max pooling), and a logistic output
gives the score.  The model is trained in numpy on a bounded labelled sample
and scores whole texts in Arrow batches inside the tasks.

Only the text enters a score.  Thresholds are calibrated by language on labelled
rows that training did not see; they turn scores into a verdict and are never
part of the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, held_out, rows_of, text_of

WIDTHS = (1, 2, 3)
_PUNCTUATION = ".,;:!?\"'()[]{}<>|*#-_&%$/\\=+~`^"
_WORDS_PER_STEP = 100_000
_CACHED_WORDS = 200_000
_LONGEST_WORD = 64
_PIECE = 16  # short enough that a word inside is not lost in the mean over the piece


def word_grams(word: str) -> list[str]:
    """The parts of a word that carry an embedding: itself, its prefixes, its trigrams to pentagrams."""
    w = word.strip(_PUNCTUATION) or word
    parts = ["=" + w]
    parts += ["^" + w[:n] for n in (3, 4, 5, 6) if len(w) > n]
    parts += [w[i : i + n] for n in (4, 5) for i in range(len(w) - n + 1)]
    return parts


def words_of(text: str | None) -> list[str]:
    """The words of a text; a longer token, as scripts without blanks have, is read as pieces that overlap by half.

    Any run of up to half a piece lies whole in one of them, so no character is left out.
    """
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= _LONGEST_WORD:
        return words
    out: list[str] = []
    for word in words:
        w = word.strip(_PUNCTUATION) or word
        if len(w) <= _LONGEST_WORD:
            out.append(word)
        else:
            out += [w[i : i + _PIECE] for i in range(0, len(w) - _PIECE // 2, _PIECE // 2)]
    return out


@dataclass
class ToxicityModel:
    embeddings: np.ndarray
    filters: list[np.ndarray]  # one of shape (width, dims, count) for each width
    biases: list[np.ndarray]
    weights: np.ndarray
    intercept: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def buckets(self, word: str) -> list[int]:
        mask = len(self.embeddings) - 1
        return [zlib.crc32(g.encode("utf-8", "surrogatepass")) & mask for g in word_grams(word)]

    def word_vectors(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, self.embeddings.shape[1]), np.float32)
        ids = [self.buckets(w) for w in words]
        counts = np.array([len(i) for i in ids])
        flat = np.fromiter((b for i in ids for b in i), np.int64, counts.sum())
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.add.reduceat(self.embeddings[flat], starts, axis=0) / counts[:, None].astype(np.float32)

    def pooled(self, vectors: np.ndarray, lengths: np.ndarray):
        """Largest response of every filter in every text, and the word it was found at."""
        pad = max(WIDTHS) - 1
        total = int(lengths.sum()) + pad * len(lengths)
        starts = np.concatenate([[0], np.cumsum(lengths + pad)[:-1]]).astype(np.int64)
        x = np.zeros((total + pad, vectors.shape[1]), np.float32)
        real = np.zeros(total, bool)
        place = np.arange(int(lengths.sum())) + np.repeat(pad * np.arange(len(lengths)), lengths)
        x[place] = vectors
        real[place] = True
        out, at = [], []
        for f, b in zip(self.filters, self.biases, strict=True):
            response = sum(x[k : k + total] @ f[k] for k in range(len(f))) + b
            np.maximum(response, 0, out=response)
            response[~real] = 0
            out.append(np.maximum.reduceat(response, starts, axis=0))
            at.append(response)
        return np.concatenate(out, axis=1), at, starts, x

    def scores(self, texts: list[list[str]], cache: WordCache) -> np.ndarray:
        out = np.empty(len(texts))
        done = 0
        for group in by_size(iter(texts), len, _WORDS_PER_STEP):
            lengths = np.array([len(t) for t in group])
            vectors = cache.vectors([w for t in group for w in t])
            features = self.pooled(vectors, lengths)[0].astype(np.float64)
            out[done : done + len(group)] = 1 / (1 + np.exp(-np.clip(features @ self.weights + self.intercept, -30, 30)))
            done += len(group)
        return out


class WordCache:
    """Vectors of the words met so far; begins anew when it holds too many."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, self.model.embeddings.shape[1]), np.float32)

    def vectors(self, words: list[str]) -> np.ndarray:
        if len(self.place) > _CACHED_WORDS:
            self._reset()
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            held = len(self.place)
            while held + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[held : held + len(new)] = self.model.word_vectors(new)
            self.place.update(zip(new, range(held, held + len(new)), strict=True))
        return self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def _train(
    texts: list[list[str]], labels: np.ndarray, buckets: int, dims: int, count: int, epochs: int, seed: int
) -> ToxicityModel:
    rng = np.random.default_rng(seed)
    model = ToxicityModel(
        rng.normal(0, 0.05, (buckets, dims)).astype(np.float32),
        [rng.normal(0, 0.3, (w, dims, count)).astype(np.float32) for w in WIDTHS],
        [np.zeros(count, np.float32) for _ in WIDTHS],
        np.zeros(len(WIDTHS) * count),
        0.0,
    )
    grams: dict[str, np.ndarray] = {}
    seen = np.zeros((2, buckets))
    for words, label in zip(texts, labels, strict=True):
        mine = set()
        for w in set(words):
            if w not in grams:
                grams[w] = np.array(model.buckets(w))
            mine.update(grams[w].tolist())
        seen[int(label), list(mine)] += 1
    # the first dimension begins as the log-odds of a bucket, which the first filter of each width reads
    n1, n0 = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    model.embeddings[:, 0] = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    for f in model.filters:
        f[:, 0, 0] = np.abs(f[:, 0, 0]) + 0.5
    model.weights[:: count] = 0.5
    model.intercept = -1.0

    squares = {"e": np.full((buckets, 1), 1e-8, np.float32)}
    slow = [np.full_like(f, 1e-8) for f in model.filters]
    slow_b = [np.full_like(b, 1e-8) for b in model.biases]
    slow_w, slow_i = np.full_like(model.weights, 1e-8), 1e-8
    for epoch in range(epochs):
        rate = 0.05 / (1 + epoch)
        order = rng.permutation(len(texts))
        for batch in by_size(iter(order), lambda i: len(texts[i]) + 1, 20_000, 64):
            group = [texts[i] for i in batch]
            lengths = np.array([len(t) for t in group])
            flat = [w for t in group for w in t]
            names = list(dict.fromkeys(flat))
            place = dict(zip(names, range(len(names)), strict=True))
            ids = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
            vectors = model.word_vectors(names)[ids] if names else np.zeros((0, dims), np.float32)
            features, responses, starts, x = model.pooled(vectors, lengths)
            score = 1 / (1 + np.exp(-np.clip(features @ model.weights + model.intercept, -30, 30)))
            error = (score - labels[batch]) / len(batch)
            g_w = features.T @ error + 1e-5 * model.weights
            g_features = (error[:, None] * model.weights[None, :]).astype(np.float32)
            ends = np.concatenate([starts[1:], [len(responses[0])]])
            word_at = np.full(len(x), -1, np.int64)
            word_at[np.arange(len(flat)) + np.repeat((max(WIDTHS) - 1) * np.arange(len(group)), lengths)] = ids
            touched: dict[int, np.ndarray] = {}
            for n, (f, b) in enumerate(zip(model.filters, model.biases, strict=True)):
                g_f, g_b = np.zeros_like(f), np.zeros_like(b)
                for d in range(len(group)):
                    if ends[d] - starts[d] <= 0 or lengths[d] == 0:
                        continue
                    best = responses[n][starts[d] : ends[d]].argmax(axis=0) + starts[d]
                    g = np.where(features[d, n * count : (n + 1) * count] > 0, g_features[d, n * count : (n + 1) * count], 0)
                    g_b += g
                    for k in range(len(f)):
                        g_f[k] += x[best + k].T * g
                        back = (f[k] * g).T  # one row for each filter
                        for c, word in enumerate(word_at[best + k]):
                            if word >= 0 and g[c]:
                                touched[word] = touched.get(word, 0) + back[c]
                slow[n] += g_f**2
                slow_b[n] += g_b**2
                f -= rate * g_f / np.sqrt(slow[n])
                b -= rate * g_b / np.sqrt(slow_b[n])
            for word, g in touched.items():
                at = grams[names[word]]
                step = g / len(at)
                np.add.at(squares["e"], at, float(step @ step))
                np.add.at(model.embeddings, at, (-rate * step / np.sqrt(squares["e"][at])).astype(np.float32))
            slow_w += g_w**2
            slow_i += error.sum() ** 2
            model.weights -= rate * g_w / np.sqrt(slow_w)
            model.intercept -= rate * error.sum() / np.sqrt(slow_i)
    return model


def _best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold between two scores that makes the fewest errors; the highest margin among equals."""
    order = np.argsort(scores)
    s, y = scores[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + ((1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)]))
    edges = np.concatenate([[0.0], s, [1.0]])
    gaps = np.diff(edges)
    at = max(range(len(errors)), key=lambda i: (-errors[i], gaps[i]))
    return float(np.clip((edges[at] + edges[at + 1]) / 2, 0.05, 0.95))


def fit_toxicity(
    texts: list[str | None],
    labels: list[int],
    langs: list[str | None],
    prior: float,
    buckets: int = 1 << 16,
    dims: int = 8,
    count: int = 6,
    epochs: int = 4,
    seed: int = 11,
    least: int = 30,
) -> ToxicityModel:
    """Train on four fifths of the rows and calibrate on the rest.

    ``prior`` is the share of toxic rows among all labelled rows; the intercept
    is moved from the sample's share to it.  A language with fewer than
    ``least`` calibration rows, or with one class only, gets the common
    threshold.  With no rows, or one class only, every score is the prior.
    """
    y = np.array(labels, np.float64)
    words = [words_of(t) for t in texts]
    fits = np.arange(len(y)) % 5 != 4
    if len(set(y[fits].tolist())) < 2:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        empty = [np.zeros((w, dims, count), np.float32) for w in WIDTHS]
        none = [np.zeros(count, np.float32) for _ in WIDTHS]
        return ToxicityModel(np.zeros((2, dims), np.float32), empty, none, np.zeros(len(WIDTHS) * count), float(np.log(p / (1 - p))))
    model = _train([w for w, f in zip(words, fits, strict=True) if f], y[fits], buckets, dims, count, epochs, seed)
    share, p = y[fits].mean(), min(max(prior, 1e-3), 1 - 1e-3)
    model.intercept += float(np.log(p / (1 - p)) - np.log(share / (1 - share)))
    rest = np.flatnonzero(~fits)
    if len(rest):
        scores = model.scores([words[i] for i in rest], WordCache(model))
        held = y[rest]
        if 0 < held.sum() < len(held):
            model.threshold = _best_threshold(scores, held)
        by_lang: dict[str, list[int]] = {}
        for n, i in enumerate(rest):
            by_lang.setdefault(langs[i] or "", []).append(n)
        for lang, at in by_lang.items():
            if len(at) >= least and 0 < held[at].sum() < len(at):
                model.thresholds[lang] = _best_threshold(scores[at], held[at])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, label: str = "toxic") -> tuple:
    """At most ``rows`` labelled rows outside the held-out fifth, half of each class where there are enough.

    Rows are chosen by digest of their id, so the choice does not depend on
    partitioning.  Returns (rows, share of label 1 among all such labels).
    """
    ours = (
        labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y"))
        .where("__id is not null and __y is not null")
        .where(~held_out("__id"))
        .groupBy("__id")
        .agg(F.max("__y").alias("__y"))
    )
    prior = ours.agg(F.avg("__y")).first()[0]
    digest = F.md5(F.concat(F.lit("sample:"), F.col("__id").cast("string")))
    picked = [ours.where(F.col("__y") == v).orderBy(digest, "__id").limit(rows // 2) for v in (0, 1)]
    # the side that is broadcast has at most ``rows`` rows
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    found = (
        docs.select(F.col("doc_id").alias("__doc"), text_of().alias("__text"), lang.alias("__lang"))
        .join(chosen, F.col("__doc") == F.col("__id"))
        .select("__doc", "__text", "__lang", "__y")
    )
    return sorted(map(tuple, found.collect()), key=lambda r: zlib.crc32(str(r[0]).encode())), float(prior or 0.0)


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = 3000, **options) -> ToxicityModel:
    """Model from at most ``rows`` labelled rows, the documented bound of the sample."""
    sample, prior = labelled_sample(docs, labels, rows)
    return fit_toxicity([r[1] for r in sample], [r[3] for r in sample], [r[2] for r in sample], prior, **options)


def _scored(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns as __k0, __k1 and so on, with score and toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: buckets x dims
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    names = [f"__k{i}" for i in range(len(keep))]
    # a kept text travels to the workers once
    read = names[keep.index("text")] if "text" in keep else "__text"
    extra = [] if "text" in keep else [text_of().alias("__text")]
    slim = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], *extra, lang.alias("__lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = WordCache(m)
        for batch in batches:
            scores = np.empty(batch.num_rows)
            done = 0
            for group in by_size(rows_of(iter([batch]), read), lambda r: len(r[0] or ""), 2_000_000):
                scores[done : done + len(group)] = m.scores([words_of(r[0]) for r in group], cache)
                done += len(group)
            limits = np.array([m.thresholds.get(x or "", m.threshold) for x in batch.column("__lang").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(scores, pa.float64()), pa.array(scores >= limits, pa.bool_())],
                [*names, "score", "toxic"],
            )

    schema = ", ".join([*[f"__k{i} {slim.schema[f'__k{i}'].dataType.simpleString()}" for i in range(len(keep))], "score double, toxic boolean"])
    return slim.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` and ``toxic`` (score against the threshold of the row's language).

    One row for each input row, repeated rows included; a null or empty text has
    no words and gets the score of no evidence.  Texts of any length are scored
    whole, a step of words at a time, and so are tokens of any length.  A null or unseen language has the common
    threshold.
    """
    return _scored(docs, model, keep).select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "score", "toxic")


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    kept = _scored(docs, model, tuple(docs.columns)).where(~F.col("toxic"))
    return kept.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(docs.columns)])


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5) and the verdict by language."""
    scored = score_toxicity(docs, train_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxic").alias("toxic_by_language"),
    )
