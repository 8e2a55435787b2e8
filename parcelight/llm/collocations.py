"""Frequent phrases and their cohesion, mined by sampling with a negative border.

A seeded share of the documents proposes phrases: those whose count in the
sample reaches a lowered threshold, and all parts of them.  One pass over all
documents then counts exactly every word, every proposed phrase and the negative
border: phrases that were not proposed although both parts one word shorter
were.  A border phrase that turns out frequent is a failure: phrases that
contain it may be frequent and were not counted.  Failures are proposed too and a
further pass counts what that adds, until no pass ends with a failure.  Whatever
the sample, the frequent phrases and their counts are exact; it only decides how
much the first pass can count.

Proposals reach the tasks as bit maps of a fixed size (Bloom filters), whatever
their number.  A fuller map lets more phrases be counted, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, rows_of, text_of
from parcelight.operators.prefix import prior_totals
from parcelight.session import cut_lineage

# Fixed values of the text rule: these bytes part pieces; A-Z are lower-cased.
BREAKS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

MAP_BITS = 26
_HELD_WORDS = 3_000_000  # words that a worker counts at once
_BREAK = b"\xff"  # in no UTF-8 text
_BYTES = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + _BREAK * len(BREAKS) + b" "
)
_COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])
_COUNTS_DDL = "lang string, size int, phrase string, a bigint"


def _spread(h: np.ndarray) -> np.ndarray:
    """Bits of a 64-bit number spread over all of it."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a pair of words from theirs; order counts."""
    return _spread(first * np.uint64(3) + _spread(second))


class BitMap:
    """Set of hashes with false finds but no false misses, of ``2 ** bits`` bits."""

    def __init__(self, words: np.ndarray, bits: int = MAP_BITS):
        self.words, self.bits = words, bits

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> np.ndarray:
        h = _spread(hashes)
        return np.concatenate([h >> np.uint64(64 - bits), _spread(h) >> np.uint64(64 - bits)])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, bool)
        at = self.places(hashes, self.bits)
        hit = (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return (hit[: len(hashes)] & hit[len(hashes) :]).astype(bool)


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


class _Numbers(dict):
    """Numbers of the words of a language in the order they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class PhraseCounter:
    """Counts the phrases of texts of one language, those that the gate lets through; without a gate all."""

    def __init__(self, lang: str, gate: Gate | None):
        self.lang, self.gate = lang, gate
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.numbers[_BREAK] = 0
        self.runs: list[np.ndarray] = []
        self.held = 0

    def add(self, texts: list[str]) -> None:
        # the line feed between two texts parts them as it parts pieces
        raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_BYTES)
        words = raw.replace(_BREAK, b" " + _BREAK + b" ").split()
        self.runs += [np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)), np.zeros(1, np.int64)]
        self.held += len(words) + 1

    def counts(self) -> Iterator[pa.RecordBatch]:
        """Phrases with their counts since the last call; forgets them."""
        if not self.runs:
            return
        ids = np.concatenate(self.runs)
        words = list(self.numbers)
        self._clear()
        texts = pa.array(words[1:], pa.binary())
        gate, plain = self.gate, self.gate is None
        size = len(words)
        if plain or gate.first:
            single = np.bincount(ids, minlength=size)
            yield self._batch(0, pa.array([b""], pa.binary()), np.array([single[1:].sum()]))
            yield self._batch(1, texts, single[1:])
        # a place where a phrase of two, or of three words starts is open if this pass counts that phrase
        pair = (ids[:-1] > 0) & (ids[1:] > 0)
        triple = pair[:-1] & pair[1:]
        if not plain:
            hashes = np.concatenate([np.zeros(1, np.uint64), _word_hashes(self.lang, words[1:])])
            new, old = gate.new[0].holds(hashes)[ids], gate.old[0].holds(hashes)[ids]
            pair &= new[:-1] & new[1:]
            spot = np.flatnonzero(pair)
            both = _joined(hashes[ids[spot]], hashes[ids[spot + 1]])
            was = old[spot] & old[spot + 1]
            inner_new, inner_old = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            # pairs that no pass has counted yet may be frequent, so longer phrases go with them
            inner_new[spot] = gate.new[1].holds(both) if gate.first else gate.new[1].holds(both) | ~was
            inner_old[spot[was]] = gate.old[1].holds(both[was])
            pair[spot[was]] = False
            triple = inner_new[:-2] & inner_new[1:-1] & ~(inner_old[:-2] & inner_old[1:-1])
        for phrase_words, open_ in ((2, pair), (3, triple)):
            parts, counts = _distinct(ids, np.flatnonzero(open_), phrase_words, size)
            yield self._batch(phrase_words, _texts(texts, *parts), counts)

    def _batch(self, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)), phrases.cast(pa.string()), pa.array(counts.astype(np.int64))],
            schema=_COUNTS,
        )


def _distinct(ids: np.ndarray, spot: np.ndarray, n: int, below: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct runs of ``n`` numbers that start at the given places, by column, and how often each occurs."""
    bits = max(1, int(below - 1).bit_length())
    if n * bits > 63:
        rows, counts = np.unique(np.stack([ids[spot + k] for k in range(n)], 1), axis=0, return_counts=True)
        return list(rows.T), counts
    keys = np.zeros(len(spot), np.int64)
    for k in range(n):
        keys = (keys << bits) | ids[spot + k]
    keys, counts = np.unique(keys, return_counts=True)
    return [(keys >> (bits * (n - 1 - k))) & ((1 << bits) - 1) for k in range(n)], counts


def _texts(words: pa.Array, *numbers: np.ndarray) -> pa.Array:
    """Phrases joined by a blank; word numbers run from 1."""
    return pc.binary_join_element_wise(*[words.take(pa.array(n - 1)) for n in numbers], pa.scalar(b" ", pa.binary()))


class Gate:
    """What a pass counts: phrases whose parts are in ``new`` maps, but not all in ``old`` ones."""

    def __init__(self, new: tuple[BitMap, BitMap], old: tuple[BitMap, BitMap], first: bool):
        self.new, self.old, self.first = new, old, first


def _in_batches(batch: pa.RecordBatch, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def counted(texts: DataFrame, gate=None) -> DataFrame:
    """(lang, size, phrase, a): exact counts over all rows of (lang, __text).

    Without a gate every phrase of up to three words is counted; a gate is a
    broadcast ``Gate``.  The row of size 0 of a language has the number of all its
    words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, PhraseCounter] = {}
        total = 0
        chosen = gate.value if gate is not None else None
        for group in by_size(rows_of(batches, "lang", "__text"), lambda r: len(r[1]), 500_000):
            by_lang: dict[str, list[str]] = {}
            for lang, text in group:
                by_lang.setdefault(lang, []).append(text)
            for lang, few in by_lang.items():
                counter = held.setdefault(lang, PhraseCounter(lang, chosen))
                before = counter.held
                counter.add(few)
                total += counter.held - before
            if total >= _HELD_WORDS or len(held) > 500:
                for c in held.values():
                    for batch in c.counts():
                        yield from _in_batches(batch)
                held, total = {}, 0
        for c in held.values():
            for batch in c.counts():
                yield from _in_batches(batch)

    # a worker has summed its phrases, so summing them again before the shuffle would find little
    parts = texts.mapInArrow(run, _COUNTS_DDL).repartition("lang", "size", "phrase")
    return parts.groupBy("lang", "size", "phrase").agg(F.sum("a").alias("a"))


def _bit_words(phrases: DataFrame, bits: int) -> DataFrame:
    """(level, word, value): the 64-bit words of both maps that are not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            for size in (1, 2):
                hashes = []
                for lang, text in zip(langs, texts, strict=True):
                    words = text.encode("utf-8", "surrogatepass").split(b" ")
                    if len(words) == size:
                        h = _word_hashes(lang, words)
                        hashes.append(h if size == 1 else _joined(h[:1], h[1:]))
                if not hashes:
                    continue
                at = np.unique(BitMap.places(np.concatenate(hashes), bits))
                word = (at >> np.uint64(6)).astype(np.int64)
                keys, starts = np.unique(word, return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), size, np.int32)), pa.array(keys), pa.array(value.view(np.int64))], ["level", "word", "value"]
                )

    made = phrases.where("size in (1, 2)").select("lang", "phrase").mapInArrow(run, "level int, word bigint, value bigint")
    return made.groupBy("level", "word").agg(F.bit_or("value").alias("value"))


def _with_bits(maps: tuple[BitMap, BitMap], phrases: DataFrame) -> tuple[BitMap, BitMap]:
    """Copies of both maps with the phrases of one and two words added; at most ``2 ** bits / 64`` words each come to the driver."""
    bits = maps[0].bits
    found = _bit_words(phrases, bits).toArrow()
    level, word = found.column("level").to_numpy(), found.column("word").to_numpy()
    value = found.column("value").to_numpy().view(np.uint64)
    out = []
    for size, old in enumerate(maps, start=1):
        words = old.words.copy()
        words[word[level == size]] |= value[level == size]
        out.append(BitMap(words, bits))
    return out[0], out[1]


def frequent_phrases(
    docs: DataFrame,
    least: int = 10,
    sample_share: float = 0.125,
    sample_least: int = 2,
    seed: int = 12,
    map_bits: int = MAP_BITS,
    report: list | None = None,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, size, phrase, a) of every phrase of one to three words that a language holds ``least`` times or more.

    A row of size 0 has the number of all words of the language.  Counts are
    exact for any ``sample_share`` between 0 and 1 and any threshold of the
    sample.  A null text is empty, a null language is ``und``; a language without
    a word has no row, an empty table gives an empty one.  ``report`` gets the
    number of border failures that each pass ended with.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(f"`{text_col}`").alias("__text"))
    proposed = cut_lineage(counted(texts.where(F.rand(seed) < sample_share)).where((F.col("size") > 0) & (F.col("a") >= sample_least)))
    empty = np.zeros(max(1, (1 << map_bits) // 64), np.uint64)
    old = (BitMap(empty, map_bits), BitMap(empty, map_bits))
    new = _with_bits(old, proposed)
    known = proposed.where("size < 3").select("lang", "phrase")
    found, turn = None, 0
    while True:
        gate = spark.sparkContext.broadcast(Gate(new, old, turn == 0))
        fresh = cut_lineage(counted(texts, gate).where((F.col("a") >= least) | (F.col("size") == 0)))
        gate.unpersist()
        found = fresh if found is None else found.unionByName(fresh)
        # an expansion counts the longer phrases of the pairs that it finds, so only pairs of the first pass can lack them
        short = "size in (1, 2)" if turn == 0 else "size = 1"
        failures = cut_lineage(fresh.where(short).join(known, ["lang", "phrase"], "left_anti"))
        failed = failures.count()
        if report is not None:
            report.append(failed)
        if not failed:
            return found
        known = known.unionByName(failures.select("lang", "phrase"))
        old, new, turn = new, _with_bits(new, failures), turn + 1


def _cut(first: int, size: int) -> tuple[Column, Column]:
    """The first so many words of a phrase and the rest."""
    return F.substring_index("phrase", " ", first), F.substring_index("phrase", " ", first - size)


def scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of candidates of two and three words, with the cut that scores lowest.

    ``frequent`` has every part, since a part is at least as frequent.  Ties go to
    the cut after fewer words.
    """
    pieces = F.when(F.col("size") == 2, F.array(*_cut(1, 2))).otherwise(F.array(*_cut(1, 3), *_cut(2, 3)))
    parts = candidates.select("lang", "size", "phrase", "a", F.posexplode(pieces).alias("__at", "part"))
    counts = frequent.where("size in (1, 2)").select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("a").alias("__f"))
    told = parts.join(counts, (F.col("lang") == F.col("__lang")) & (F.col("part") == F.col("__part")))
    cuts = told.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), *[F.max(F.when(F.col("__at") == i, F.col("__f"))).alias(name) for i, name in enumerate(("l1", "r1", "l2", "r2"))]
    )
    score = lambda k: F.expr(
        "cast(cast(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(31,0)) * cast(1000000 as decimal(7,0)) as decimal(38,0))"
        f" div (cast(l{k} as decimal(18,0)) * cast(r{k} as decimal(18,0)))"
    )
    both = cuts.withColumn("__s1", score(1)).withColumn("__s2", score(2))
    second = F.coalesce(F.col("__s2") < F.col("__s1"), F.lit(False))
    return both.select(
        "lang",
        "phrase",
        "a",
        F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(second, F.col("__s2")).otherwise(F.col("__s1")).alias("score"),
    )


def without_parts(candidates: DataFrame, share: int = 50) -> DataFrame:
    """Candidates without those of which ``share`` percent or more lie inside one longer candidate."""
    inside = (
        candidates.where("size = 3")
        .select("lang", "a", F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("__inner"))
        .groupBy(F.col("lang").alias("__lang"), "__inner")
        .agg(F.max("a").alias("__longer"))
    )
    held = candidates.join(inside, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__inner")), "left")
    return held.where(F.col("__longer").isNull() | (100 * F.col("__longer") < share * F.col("a"))).select(*candidates.columns)


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, report: list | None = None, **sampling) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of each language that hold together best.

    Order: score, then count, both falling, then the phrase's bytes; no two
    phrases tie.  Texts and languages that are null, and repeated rows, as in
    ``frequent_phrases``; ``docs`` may have any other columns.
    """
    frequent = frequent_phrases(docs, least, report=report, **sampling)
    left = scored(without_parts(frequent.where("size > 1"), share), frequent)
    # the best of each of a fixed number of slices, then positions over range-partitioned blocks:
    # the rows of a language never meet in one task
    slices = Window.partitionBy("lang", "__slice").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    sliced = left.withColumn("__slice", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    few = sliced.withColumn("__place", F.row_number().over(slices)).where(F.col("__place") <= top)
    few = cut_lineage(few.select("*", (-F.col("score")).alias("__score"), (-F.col("a")).alias("__a")))
    placed = prior_totals(few, ["__score", "__a", "phrase"], {"__before": F.lit(1).cast("bigint")}, partition_by=["lang"])
    best = placed.where(F.col("__before") < top)
    sizes = frequent.where("size = 0").select(F.col("lang").alias("__lang"), F.col("a").alias("n"))
    return best.join(sizes, F.col("lang") == F.col("__lang")).select(
        "lang", (F.col("__before") + 1).cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


COLLOCATION_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, doc_id,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
phrases as (
    select lang, k as size, array_to_string(w[i : i + k - 1], ' ') as phrase
    from starts, range(1, 4) r(k) where i + k - 1 <= len(w)),
counts as materialized (select lang, size, phrase, count(*) as a from phrases group by all),
sizes as (select lang, sum(a) as n from counts where size = 1 group by lang),
candidates as materialized (
    select *, string_split(phrase, ' ') as w from counts where size > 1 and a >= 10),
splits as materialized (
    select lang, size, phrase, w, a, k, array_to_string(w[1 : k], ' ') as part, array_to_string(w[k + 1 : size], ' ') as rest
    from (select *, unnest(range(1, size)) as k from candidates)),
frequent as materialized (select lang, phrase, a from counts where size < 3 and a >= 10),
cuts as (
    select c.lang, c.size, c.phrase, c.w, c.a, k, f.a as l, g.a as r,
        cast(1000000 as hugeint) * c.a * c.a // (cast(f.a as hugeint) * g.a) as score
    from splits c
    join frequent f on f.lang = c.lang and f.phrase = c.part
    join frequent g on g.lang = c.lang and g.phrase = c.rest),
scored as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select lang, array_to_string(w[j : j + 1], ' ') as phrase, max(a) as longer
    from (select *, unnest([1, 2]) as j from candidates where size = 3) group by all),
left_over as (
    select s.* from scored s left join inside i on s.size = 2 and s.lang = i.lang and s.phrase = i.phrase
    where i.longer is null or 100 * i.longer < 50 * s.a),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from left_over)
select r.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
    cast(n as bigint) as n, cast(score as bigint) as score
from ranked r join sizes s on r.lang = s.lang where rank <= 2000
"""
