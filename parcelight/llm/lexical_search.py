"""Ranked lexical search over posting lists in geometric blocks.

Documents are searched in segments of a bounded number of documents, wherever
Spark reads them; only the best of each segment are shuffled.  Within a segment
a term's posting list is clustered by similarity: documents are points (random
projections of their term vectors) and the list is halved along its widest
direction until a block is small.  A block stores its summary, for every term the
largest value that any of its documents has, so the product of summary and query
is at least the score of each document in it.  A block is skipped only if that
bound is below the score of the worst hit that the query holds so far; lists are
taken by falling weight, and what the remaining lists could add at most ends a
query early.  Both bounds are exact, so the ranking is that of a full scan.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parcelight.llm.common import rows_of, text_of
from parcelight.session import cut_lineage

HITS = 10
_SEGMENT_DOCS = 4096
_SEGMENT_POSTINGS = 2_000_000
_BLOCK_DOCS = 32
_GROUP_TERMS = 1024  # terms of the queries that are searched together
_DIRECTIONS = 8
_BLOCK_BYTES = 16_000_000  # texts of queries that one pass over the documents carries

# Fixed rule of terms: ASCII letters and digits and all that is not ASCII; A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class _Vocabulary(dict):
    """Numbers of the queries' terms; any other term is -1."""

    def __missing__(self, term: bytes) -> int:
        return -1


@dataclass
class Group:
    """Queries that are searched together, over the terms they hold."""

    items: np.ndarray  # numbers of the queries
    terms: np.ndarray  # numbers of their terms, by falling weight
    weights: np.ndarray  # (query, term): weight times occurrences in the query, as double


@dataclass
class Queries:
    """Queries with their weights and the figures of the corpus that scores need."""

    vocabulary: dict
    groups: list[Group]
    n_docs: int
    n_terms: int


def numbered_terms(texts: list[str]) -> tuple[_Vocabulary, list[Counter]]:
    """All terms of the queries with numbers, and each query's terms with their occurrences."""
    vocabulary, bags = _Vocabulary(), []
    for text in texts:
        bag = Counter(terms_of(text))
        for term in bag:
            if term not in vocabulary:
                vocabulary[term] = len(vocabulary)
        bags.append(Counter({vocabulary[t]: c for t, c in bag.items()}))
    return vocabulary, bags


def weighed(vocabulary: dict, bags: list[Counter], held: dict[int, int], n_docs: int, n_terms: int) -> Queries:
    """Queries in groups of about ``_GROUP_TERMS`` terms; ``held`` has the documents of each term."""
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in held.items() if df}
    groups, taken, terms = [], [], set()

    def close():
        order = sorted(terms, key=lambda t: (-weight[t], t))
        place = {t: i for i, t in enumerate(order)}
        matrix = np.zeros((len(taken), len(order)))
        for row, item in enumerate(taken):
            for t, count in bags[item].items():
                if t in place:
                    matrix[row, place[t]] = weight[t] * count
        groups.append(Group(np.array(taken), np.array(order, np.int64), matrix))

    for item, bag in enumerate(bags):
        own = {t for t in bag if weight.get(t, 0) > 0}
        if not own:
            continue
        if taken and len(terms | own) > _GROUP_TERMS:
            close()
            taken, terms = [], set()
        taken.append(item)
        terms |= own
    if taken:
        close()
    return Queries(vocabulary, groups, n_docs, n_terms)


@dataclass
class Segment:
    """Documents with their terms' values, in rows."""

    ids: list = field(default_factory=list)
    starts: list = field(default_factory=lambda: [0])
    terms: list = field(default_factory=list)
    values: list = field(default_factory=list)

    def add(self, doc_id, text: str, queries: Queries) -> None:
        words = terms_of(text)
        numbers = np.fromiter(map(queries.vocabulary.__getitem__, words), np.int64, len(words))
        terms, tf = np.unique(numbers[numbers >= 0], return_counts=True)
        if not len(terms):
            return
        m = 100 - 75 + (75 * len(words) * queries.n_docs) // queries.n_terms
        self.ids.append(doc_id)
        self.terms.append(terms)
        self.values.append((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        self.starts.append(self.starts[-1] + len(terms))

    @property
    def full(self) -> bool:
        return len(self.ids) >= _SEGMENT_DOCS or self.starts[-1] >= _SEGMENT_POSTINGS


def geometric_blocks(docs: np.ndarray, points: np.ndarray, most: int = _BLOCK_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a posting list so that similar ones are neighbours, and where each block of at most ``most`` starts."""
    todo, order, starts, at = [docs], [], [], 0
    while todo:
        group = todo.pop()
        if len(group) <= most:
            order.append(group)
            starts.append(at)
            at += len(group)
            continue
        near = points[group]
        along = near[:, np.argmax(near.max(0) - near.min(0))]
        half = len(group) // 2
        parted = np.argpartition(along, half)
        todo += [group[parted[half:]], group[parted[:half]]]
    return np.concatenate(order), np.array(starts)


class Best:
    """The best hits of each query so far: (-score, id is null, id), smallest first."""

    def __init__(self, hits: int):
        self.hits = hits
        self.held: dict[int, list] = {}
        self.evaluated = self.skipped = 0  # pairs of block and query

    def least(self, item: int) -> int:
        """A document below this score is no hit."""
        held = self.held.get(item, ())
        return -held[-1][0] if len(held) == self.hits else 1

    def add(self, item: int, found: list) -> None:
        self.held[item] = heapq.nsmallest(self.hits, [*self.held.get(item, ()), *found])


def search_segment(segment: Segment, queries: Queries, best: Best, block_docs: int = _BLOCK_DOCS) -> None:
    """Add the segment's hits to ``best``."""
    n = len(segment.ids)
    if not n:
        return
    rows = np.repeat(np.arange(n), np.diff(segment.starts))
    terms, values = np.concatenate(segment.terms), np.concatenate(segment.values)
    directions = np.random.default_rng(5)
    for group in queries.groups:
        place = np.full(len(queries.vocabulary), -1, np.int64)
        place[group.terms] = np.arange(len(group.terms))
        own = place[terms] >= 0
        vectors = np.zeros((n, len(group.terms)))
        vectors[rows[own], place[terms[own]]] = values[own]
        points = vectors @ directions.normal(size=(len(group.terms), _DIRECTIONS))
        by_term = np.argsort(place[terms[own]], kind="stable")
        postings = rows[own][by_term]
        ends = np.searchsorted(place[terms[own]][by_term], np.arange(len(group.terms) + 1))
        # the most that the lists from a term on can add to a query
        highest = vectors.max(0)
        rest = np.cumsum((group.weights * highest)[:, ::-1], axis=1)[:, ::-1]
        least = np.array([best.least(i) for i in group.items], float)
        done = np.zeros((len(group.items), n), bool)
        for t in range(len(group.terms)):
            docs = postings[ends[t] : ends[t + 1]]
            asked = np.flatnonzero((group.weights[:, t] > 0) & (rest[:, t] >= least))
            if not len(docs) or not len(asked):
                continue
            order, starts = geometric_blocks(docs, points, block_docs)
            summaries = np.maximum.reduceat(vectors[order], starts, axis=0)
            bounds = summaries @ group.weights[asked].T
            sizes = np.diff([*starts, len(order)])
            for column, row in enumerate(asked):
                open_ = bounds[:, column] >= least[row]
                best.skipped += int(len(open_) - open_.sum())
                best.evaluated += int(open_.sum())
                todo = order[np.repeat(open_, sizes)]
                todo = todo[~done[row, todo]]
                if not len(todo):
                    continue
                done[row, todo] = True
                scores = vectors[todo] @ group.weights[row]
                good = scores >= least[row]
                if good.any():
                    item = int(group.items[row])
                    pairs = zip(todo[good].tolist(), scores[good].tolist(), strict=True)
                    best.add(item, [(-int(s), segment.ids[d] is None, segment.ids[d]) for d, s in pairs])
                    least[row] = best.least(item)


def _figures(docs: DataFrame, vocabulary) -> DataFrame:
    """(term, value): documents of each query term; -1: documents with a term; -2: all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        df = np.zeros(len(known) + 1, np.int64)
        n_docs = n_terms = 0
        for (text,) in rows_of(batches, "__text"):
            words = terms_of(text)
            n_terms += len(words)
            n_docs += bool(words)
            df[np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))] += 1
        term = np.flatnonzero(df[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([*term.tolist(), -1, -2], pa.int64()), pa.array([*df[term].tolist(), n_docs, n_terms], pa.int64())], ["term", "value"]
        )

    return docs.select("__text").mapInArrow(run, "term bigint, value bigint").groupBy("term").agg(F.sum("value").alias("value"))


def _hits(docs: DataFrame, queries, hits: int, block_docs: int) -> DataFrame:
    """(item, doc_id, score): the best of the documents that a task reads."""
    doc_type = docs.schema["__id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = queries.value
        best, segment = Best(hits), Segment()
        for doc_id, text in rows_of(batches, "__id", "__text"):
            segment.add(doc_id, text, told)
            if segment.full:
                search_segment(segment, told, best, block_docs)
                segment = Segment()
        search_segment(segment, told, best, block_docs)
        found = [(item, doc, -score) for item, held in best.held.items() for score, _, doc in held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], to_arrow_type(doc_type)),
                pa.array([f[2] for f in found], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return docs.select("__id", "__text").mapInArrow(run, f"item bigint, doc_id {doc_type.simpleString()}, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    hits: int = HITS,
    block_docs: int = _BLOCK_DOCS,
    block_bytes: int = _BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``hits`` documents of each item that score highest, above 0.

    Queries go to the tasks in blocks of about ``block_bytes`` of text, each block
    with a pass over the documents, so what is broadcast is bounded whatever
    the number of queries.  A null or empty text has no terms: such a document is
    no hit, such an item has no rows.  Equal scores are in the order of ids, a null
    id last.  Rows that repeat an id are documents, or queries, of their own.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").alias("__id"), text_of(f"`{text_col}`").alias("__text"))
    asked = cut_lineage(
        items.select(F.col(f"`{item_col}`").alias("item_id"), text_of("`text`").alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    )
    size = asked.agg(F.coalesce(F.sum(F.octet_length("__text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    parts = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("__row"), F.lit(blocks)) == block).select("__row", "__text").orderBy("__row").toArrow()
        vocabulary, bags = numbered_terms(rows.column("__text").to_pylist())
        known = spark.sparkContext.broadcast(vocabulary)
        figures = {r["term"]: r["value"] for r in _figures(slim, known).collect()}  # at most a row for each term of the block
        n_docs, n_terms = figures.pop(-1, 0), figures.pop(-2, 0)
        queries = spark.sparkContext.broadcast(weighed(vocabulary, bags, figures, n_docs, n_terms))
        numbers = rows.column("__row").to_pylist()
        if not numbers:
            continue
        names = spark.createDataFrame(list(enumerate(numbers)), "__item bigint, __of bigint")
        found = _hits(slim, queries, hits, block_docs)
        parts.append(found.join(names, F.col("item") == F.col("__item")).select("__of", "doc_id", "score"))
    empty = slim.limit(0).select(F.lit(0).cast("bigint").alias("__of"), F.col("__id").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    found = empty
    for part in parts:
        found = found.unionByName(part)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    # the best of each of a fixed number of slices first: a query's hits never meet in one task before
    sliced = found.withColumn("__slice", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    few = sliced.withColumn("__place", F.row_number().over(Window.partitionBy("__of", "__slice").orderBy(*order))).where(F.col("__place") <= hits)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("__of").orderBy(*order))).where(F.col("rank") <= hits)
    return ranked.join(asked, F.col("__of") == F.col("__row")).select("item_id", "rank", "doc_id", "score")


SEARCH_SQL = r"""
with terms as (
    select doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents),
asked as (
    select item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark),
lengths as (select doc_id, count(*) as n from terms group by doc_id),
corpus as (select count(*) as docs, sum(n)::bigint as len from lengths),
postings as (select doc_id, term, count(*) as tf from terms where term in (select term from asked) group by all),
weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, corpus group by term, docs),
scores as (
    select q.item_id, p.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len))))::bigint as score
    from asked q join postings p using (term) join weights using (term) join lengths using (doc_id), corpus
    group by q.item_id, p.doc_id),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""
