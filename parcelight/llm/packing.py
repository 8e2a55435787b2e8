"""Best-fit packing of token runs by a grouping genetic algorithm on islands.

Documents are cut into pieces of at most one sequence.  Full pieces are
sequences of their own; the others are dealt to islands of bounded size.  An
island evolves a few packings: each begins with best fit over a (disturbed)
descending order, a crossover injects whole well-filled bins of one parent into
another, drops the bins that share a document with them and places the displaced
documents by best fit.

Between rounds a share of the elite, the fullest bins of an island's best packing,
migrates together with the bins that are not full; the rest of the elite is final.
What migrates arrives on fewer islands, where one packing of the first
generation holds the bins as they came, so that crossover can inject the elite of
other islands there.  A piece travels with its bin, so it is in one place at any
time, and no island ever holds more than a bounded number of pieces.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, rows_of, text_of
from parcelight.session import cut_lineage

SEQUENCE = 4096
END_OF_TEXT = 1
_CACHED_WORDS = 500_000  # of each of two generations
_MARKS = ".,;:!?*&%#"
# Latin letters up to U+017F whose lower case is one letter.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch


class WordTokens:
    """Token ids of a text by a tokenizer that drops white space, as little-endian bytes.

    The tokenizer splits at white space, so a text's ids are those of its words
    one after the other; words are remembered.  Plain words of Latin letters,
    which are one unit of its splitting rule, are run through its merges in one
    call; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = file.read()
        self.whole = Tokenizer.from_str(content)
        settings = json.loads(content)
        settings |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(settings))
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        # byte-level tokenizers write a byte that does not print as a letter from U+0100 on
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = np.arange(256, dtype="<u4")
        hidden = [b for b in range(256) if b not in set(printed)]
        self.letters[hidden] = 256 + np.arange(len(hidden))
        self.letters[32] = 32  # parts the words of a run
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _forms(self, words: list[str]) -> list[str]:
        """Words of Latin letters as the merges read them."""
        text = unicodedata.normalize("NFC", " ".join(words)).lower()
        if not text.isascii():
            text = self.letters[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        return text.split(" ")

    def _merge(self, words: list[str]) -> None:
        """Ids of words that are one unit each, from one run of the merges over many."""
        for at in range(0, len(words), 4000):
            group = words[at : at + 4000]
            forms = self._forms(group)
            ids = np.array(self.merges.encode_batch_fast([" ".join(forms)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) != len(group) or len(forms) != len(group):
                self.known.update((w, self._slow(w)) for w in group)
                continue
            raw, cuts = ids.tobytes(), cuts.tolist()
            self.known.update(zip(group, [raw[i:j] for i, j in zip([0, *cuts], cuts, strict=False)], strict=True))

    def learn(self, words: set[str]) -> None:
        """Take words in that are not known."""
        if len(self.known) > _CACHED_WORDS:
            # words that come again move over from the older half, the others are forgotten
            self.older, self.known = self.known, {}
        if len(self.marks) > 10_000:
            self.marks = {}
        known, older, marks, slow = self.known, self.older, self.marks, self._slow
        if older:
            again = {w: older[w] for w in words if w in older}
            known.update(again)
            words = words.difference(again)
        ascii_, latin, marked = [], [], []
        for w in words:
            s = w.rstrip(_MARKS)
            if not _LATIN(s):
                known[w] = slow(w)
                continue
            if len(s) != len(w):
                marked.append((w, s))
                if s in known or s in words:
                    continue
            (ascii_ if s.isascii() else latin).append(s)
        # a stem may come with several marks
        self._merge(list(dict.fromkeys(ascii_)))
        self._merge(list(dict.fromkeys(latin)))
        for w, s in marked:
            # marks after plain letters are one unit of the splitting rule
            tail = w[len(s) :]
            if tail not in marks:
                marks[tail] = slow(tail)
            known[w] = known[s] + marks[tail]

    def many(self, texts: list[str]) -> Iterator[bytes]:
        # U+001C to U+001F part words in Python but not for the tokenizer
        split = [None if any(c in t for c in "\x1c\x1d\x1e\x1f") else t.split() for t in texts]
        flat = list(chain.from_iterable(w for w in split if w is not None))
        ids = list(map(self.known.get, flat))
        open_ = [n for n, i in enumerate(ids) if i is None]
        self.learn({flat[n] for n in open_})
        known, at = self.known, 0
        for n in open_:
            ids[n] = known[flat[n]]
        for text, words in zip(texts, split, strict=True):
            if words is None:
                yield self._slow(text)
            else:
                yield b"".join(ids[at : at + len(words)])
                at += len(words)


@lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document cut at multiples of ``sequence``.

    A document is its ids and the end id; a null text is empty and gives one
    piece of one id.  Rows are independent, so repeated rows give repeated pieces.
    """
    end = np.array([END_OF_TEXT], "<u4").tobytes()
    step = 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        for group in by_size(rows_of(batches, "doc_id", "__text"), lambda r: len(r[1]), 100_000, 2000):
            out: list[list] = [[], [], [], [], []]
            for (doc, _), ids in zip(group, tokens.many([r[1] for r in group]), strict=True):
                raw = ids + end
                for piece, at in enumerate(range(0, len(raw), step)):
                    part = raw[at : at + step]
                    for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    slim = docs.select("doc_id", text_of().alias("__text"))
    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = slim.schema["doc_id"].dataType
    types = [to_arrow_type(doc_type), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = f"doc_id {doc_type.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return slim.mapInArrow(run, schema)


class Packing:
    """Bins of item numbers with their fill."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def place(self, items: list[int]) -> Packing:
        """Best fit: each item goes where the least room is left."""
        gaps = sorted((self.capacity - f, b) for b, f in enumerate(self.fill))
        for item in items:
            size = int(self.sizes[item])
            at = bisect_left(gaps, (size, -1))
            if at == len(gaps):
                self.bins.append([item])
                self.fill.append(size)
                insort(gaps, (self.capacity - size, len(self.bins) - 1))
            else:
                gap, b = gaps.pop(at)
                self.bins[b].append(item)
                self.fill[b] += size
                insort(gaps, (gap - size, b))
        return self

    def holding(self, bins: list[list[int]]) -> Packing:
        for items in bins:
            self.bins.append(list(items))
            self.fill.append(int(self.sizes[items].sum()))
        return self

    @property
    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then the mean squared fill."""
        return -len(self.bins), float(np.mean((np.array(self.fill) / self.capacity) ** 2)) if self.bins else 0.0


def _descending(sizes: np.ndarray, items, rng=None, noise: float = 0.0) -> list[int]:
    items = np.asarray(items, np.int64)
    keys = sizes[items] * (1 + (rng.normal(0, noise, len(items)) if noise else 0))
    return items[np.argsort(-keys, kind="stable")].tolist()


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Whole well-filled bins of ``b`` enter ``a``; bins of ``a`` that share an item with them, and its emptiest, are dissolved."""
    full = np.array(b.fill)
    good = np.flatnonzero(full >= np.median(full))
    taken = rng.choice(good, max(1, len(good) // 3), replace=False)
    injected = [b.bins[i] for i in taken]
    held = {i for items in injected for i in items}
    emptiest = set(np.argsort(a.fill, kind="stable")[: max(1, len(a.fill) // 20)].tolist())
    kept, displaced = [], []
    for n, items in enumerate(a.bins):
        if n in emptiest or not held.isdisjoint(items):
            displaced.extend(i for i in items if i not in held)
        else:
            kept.append(items)
    child = Packing(a.sizes, a.capacity).holding(injected).holding(kept)
    return child.place(_descending(a.sizes, displaced))


def evolve(
    sizes: np.ndarray, capacity: int, seed: int, arrived: list[list[int]] | None = None, population: int = 4, generations: int = 8
) -> Packing:
    """The best packing of an island; stops at the bound that no packing can beat."""
    rng = np.random.default_rng(seed)
    everything = np.arange(len(sizes))
    bound = -(-int(sizes.sum()) // capacity)
    alive = [Packing(sizes, capacity).place(_descending(sizes, everything))]
    if arrived:
        alive.append(Packing(sizes, capacity).holding(arrived))
    for turn in range(generations):
        alive.sort(key=lambda p: p.fitness, reverse=True)
        if len(alive[0].bins) <= bound:
            break
        while len(alive) < population:
            alive.append(Packing(sizes, capacity).place(_descending(sizes, everything, rng, 0.05 * (1 + turn))))
        first, second = rng.choice(len(alive), 2, replace=False)
        children = [crossover(alive[0], alive[max(first, 1)], rng), crossover(alive[first], alive[second], rng)]
        alive = sorted([*alive, *children], key=lambda p: p.fitness, reverse=True)[:population]
    return max(alive, key=lambda p: p.fitness)


def emigrants(best: Packing, elite: float, share: float) -> set[int]:
    """The fullest of the bins that are full enough to be final: so many go on to another island as they are."""
    full = [n for n, fill in enumerate(best.fill) if fill >= elite * best.capacity]
    return set(sorted(full, key=lambda n: (-best.fill[n], n))[: int(len(full) * share)])


def _island(sequence: int, seed: int, turn: int, last: bool, elite: float, share: float):
    def run(key, group):
        group = group.sort_values("__row", ignore_index=True)
        sizes = group["__size"].to_numpy()
        arrived = [list(g) for b, g in group.groupby("__bin").groups.items() if b >= 0]
        best = evolve(sizes, sequence, seed + int(key[0]), arrived)
        leaving = set() if last else emigrants(best, elite, share)
        bin_of, offset, final = np.empty(len(group), np.int64), np.empty(len(group), np.int64), np.empty(len(group), bool)
        for n, (items, fill) in enumerate(zip(best.bins, best.fill, strict=True)):
            bin_of[items] = (turn << 58) | (int(key[0]) << 22) | n
            offset[items] = np.cumsum(sizes[items]) - sizes[items]
            final[items] = last or (fill >= elite * sequence and n not in leaving)
        return pd.DataFrame({"__row": group["__row"], "__size": sizes, "__bin": bin_of, "__offset": offset, "__final": final})

    return run


def pack(
    pieces: DataFrame,
    sequence: int = SEQUENCE,
    island: int = 1500,
    rounds: int = 4,
    elite: float = 0.999,
    share: float = 0.1,
    seed: int = 7,
) -> DataFrame:
    """``pieces`` with sequence_id and offset; every piece is placed once, no sequence is overfull.

    ``pieces`` needs ``length`` between 1 and ``sequence``.  Equal rows are
    separate pieces.  An empty table gives an empty table.  ``share`` of the bins
    filled to ``elite`` or more migrate between rounds, the others are final.
    """
    kept = pieces.columns
    stored = cut_lineage(pieces.withColumn("__row", F.monotonically_increasing_id()))
    full = stored.where(F.col("length") >= sequence).select(
        *kept, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    todo = stored.where(F.col("length") < sequence).select("__row", F.col("length").alias("__size"), F.lit(-1).cast("bigint").alias("__bin"))
    placed = None
    for turn in range(rounds):
        left = todo.count()
        if left == 0 and turn:
            break
        islands = max(1, -(-left // island))
        last = turn == rounds - 1 or islands == 1
        # pieces of a bin that migrates stay together
        home = F.when(F.col("__bin") < 0, F.xxhash64(F.lit(seed), "__row")).otherwise(F.xxhash64(F.lit(seed + turn), "__bin"))
        dealt = todo.withColumn("__island", F.pmod(home, F.lit(islands)))

        done = cut_lineage(
            dealt.groupBy("__island").applyInPandas(_island(sequence, seed, turn, last, elite, share), "__row bigint, __size bigint, __bin bigint, __offset bigint, __final boolean")
        )
        final = done.where("__final").select("__row", F.col("__bin").alias("sequence_id"), F.col("__offset").alias("offset"))
        placed = final if placed is None else placed.unionByName(final)
        todo = done.where(~F.col("__final")).select("__row", "__size", "__bin")
        if last:
            break
    partial = stored.where(F.col("length") < sequence).join(placed, "__row").select(*kept, "sequence_id", "offset")
    return full.unionByName(partial)


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Every document's pieces with the sequence and place that each got.

    A null text is an empty document, one piece of the end id; rows that repeat
    an id or a text are documents of their own; ties in size keep the order of
    rows.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    return pack(token_pieces(docs, tokenizer or default_tokenizer()))
