"""Removal of repeated byte strings by difference-cover sampling of suffixes.

A suffix array over the whole corpus would be sorted only to learn which
suffixes agree in their first 200 bytes.  This is the distributed
difference-cover construction cut down to that question:

1. *Sample.*  Positions whose place in the document falls into a difference
   cover modulo v are sampled.  For any two positions some shift below v takes
   both into the sample, so two equal strings of ``length`` bytes hold a pair of
   equal sampled tuples of ``length - v + 1`` bytes.  Sampled tuples are sorted
   by name; a tuple that occurs once rules its surroundings out.
2. *Recurse on names.*  The sampled suffixes that are left are named anew by
   ``length + v - 1`` bytes.  A repeated one proves all suffixes that begin within
   v bytes of it to be repeated.
3. *Merge the remaining suffixes.*  The others, near the ends of repeats, are
   named by their first ``length`` bytes, together with one copy of the proven
   ones.  After the sort, neighbours with equal names are equal prefixes.

Names are digests of the bytes (equality is all that is asked of their order).
Documents travel in blocks.  A block sends each name once, as sorted runs, and
gets back one bit for each, so that a string held by any number of documents
costs a block one name, and no group is ever gathered.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, rows_of, text_of
from parcelight.session import cut_lineage

# Perfect difference sets: every difference modulo v occurs exactly once.
COVERS = {
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    133: (1, 11, 16, 40, 41, 43, 52, 60, 74, 78, 121, 128),
}
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_TABLES = [np.random.default_rng(s).integers(0, 1 << 64, 256, dtype=np.uint64) for s in (101, 202)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest cover that leaves tuples of a third of ``length``."""
    modulus = max(v for v in COVERS if v * 3 <= 2 * length or v == min(COVERS))
    if length <= modulus:
        raise ValueError(f"length must be over {modulus}")
    return modulus, COVERS[modulus]


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    held = _POWERS.get(which)
    if held is None or len(held[0]) <= n:
        base = _BASES[which]
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n + 1, b, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            pair.append(p)
        _POWERS[which] = held = (pair[0], pair[1])
    return held


class Block:
    """Some documents' bytes, one after the other."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray, data: bytes):
        self.rows, self.lengths = np.asarray(rows, np.int64), np.asarray(lengths, np.int64)
        self.data = data
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self._sums: dict[int, np.ndarray] = {}

    def packed(self) -> bytes:
        head = np.concatenate([[len(self.rows)], self.rows, self.lengths]).astype("<i8").tobytes()
        return zstandard.ZstdCompressor(level=3).compress(head + self.data)

    @staticmethod
    def unpacked(raw: bytes) -> Block:
        raw = zstandard.ZstdDecompressor().decompress(raw)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        head = np.frombuffer(raw, "<i8", 2 * n, 8)
        return Block(head[:n], head[n:], raw[8 + 16 * n :])

    def part(self, chosen: np.ndarray) -> Block:
        data = b"".join(self.data[s:e] for s, e in zip(self.starts[chosen], self.ends[chosen], strict=True))
        return Block(self.rows[chosen], self.lengths[chosen], data)

    def _sum(self, which: int) -> np.ndarray:
        if which not in self._sums:
            b = np.frombuffer(self.data, np.uint8)
            sums = np.zeros(len(b) + 1, np.uint64)
            terms = _TABLES[which][b]
            terms *= _powers(which, len(b))[0][: len(b)]
            np.cumsum(terms, out=sums[1:])
            self._sums[which] = sums
        return self._sums[which]

    def digest(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        """Hash of the ``length`` bytes from each position, the same wherever they stand."""
        sums = self._sum(which)
        h = (sums[at + length] - sums[at]) * _powers(which, len(self.data))[1][at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def sampled(self, length: int, modulus: int, cover: tuple[int, ...]) -> np.ndarray:
        """Positions in the cover, counted in each document, with ``length`` bytes after them."""
        out = []
        for s, n in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            if n >= length:
                at = (np.arange(0, n - length + 1, modulus)[:, None] + np.array(cover)[None, :]).ravel()
                out.append(at[at <= n - length] + s)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def document_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")


class Names:
    """Sorted distinct names of some positions; ``twice`` marks those found more than once here."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        order = np.lexsort((low, high))
        h, x = high[order], low[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (x[1:] != x[:-1])
        self.high, self.low = h[new], x[new]
        self.which = np.empty(len(h), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.twice = np.bincount(self.which, minlength=len(self.high)) > 1

    def messages(self, buckets: int, flags: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
        """Runs of names for each bucket, a range of the names; ``flags`` go in the place of the last byte."""
        low = self.low if flags is None else flags.astype(np.uint8)
        places = ((self.high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edges = np.searchsorted(places, np.arange(buckets + 1, dtype=np.uint64))
        press = zstandard.ZstdCompressor(level=1)
        for b in range(buckets):
            i, j = edges[b], edges[b + 1]
            if i < j:
                steps = np.diff(self.high[i:j], prepend=np.uint64(0))
                planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()  # high bytes of small steps are zero
                yield b, press.compress(planes + low[i:j].tobytes())


def _read_names(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = len(raw) // 9
    steps = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T.copy().view(np.uint64).ravel()
    return np.cumsum(steps), np.frombuffer(raw, np.uint8, n, 8 * n)


def _answer(group):
    """For every block's names: whether another block has them, and whether this block is the first of those."""
    parts = [_read_names(x) for x in group["data"]]
    sizes = [len(p[0]) for p in parts]
    high, low = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    owner = np.repeat(np.arange(len(parts)), sizes)
    order = np.lexsort((owner, low, high))
    h, x = high[order], low[order]
    same = (h[1:] == h[:-1]) & (x[1:] == x[:-1])
    again, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    later[order[1:]] = same
    ends = np.cumsum(sizes)
    answers = [
        np.packbits(np.concatenate([again[e - n : e], ~later[e - n : e]])).tobytes() for e, n in zip(ends, sizes, strict=True)
    ]
    return pd.DataFrame({"block": group["block"], "turn": group["turn"], "bucket": group["bucket"], "size": sizes, "answer": answers})


def _answer_any(group):
    """For every block's names: whether any block flags them."""
    parts = [_read_names(x) for x in group["data"]]
    sizes = [len(p[0]) for p in parts]
    _, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    which, flags = which.ravel(), np.concatenate([p[1] for p in parts])
    flagged = (np.bincount(which, flags) > 0)[which]
    answers = [np.packbits(np.concatenate([x, x])).tobytes() for x in np.split(flagged, np.cumsum(sizes)[:-1])]
    return pd.DataFrame({"block": group["block"], "turn": group["turn"], "bucket": group["bucket"], "size": sizes, "answer": answers})


def _answers(messages: DataFrame, answer=_answer) -> DataFrame:
    return messages.groupBy("bucket").applyInPandas(answer, "block bigint, turn int, bucket int, size bigint, answer binary")


def _bits(answers: pd.DataFrame, turn: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    mine = answers[answers["turn"] == turn].sort_values("bucket")
    again, first = [], []
    for size, raw in zip(mine["size"], mine["answer"], strict=True):
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=2 * size).astype(bool)
        again.append(bits[:size])
        first.append(bits[size:])
    joined = [np.concatenate(x) if x else np.zeros(0, bool) for x in (again, first)]
    if len(joined[0]) != n:
        raise RuntimeError("the documents changed between two reads of them")
    return joined[0], joined[1]


class Search:
    """The three turns of one block; each recomputes what it asked from the bytes and the answers so far."""

    def __init__(self, length: int):
        self.length = length
        self.modulus, self.cover = cover_for(length)
        self.short, self.long = length - self.modulus + 1, length + self.modulus - 1

    def ask_sample(self, block: Block) -> tuple[np.ndarray, Names]:
        at = block.sampled(self.short, self.modulus, self.cover)
        return at, self._sample_names(block, at)

    def _sample_names(self, block: Block, at: np.ndarray) -> Names:
        # these only rule out, so 48 bits are enough
        h = block.digest(at, self.short, 0)
        return Names(h & np.uint64(0xFFFFFFFFFFFF0000), np.zeros(len(h), np.uint8))

    def _names(self, block: Block, at: np.ndarray, length: int) -> Names:
        return Names(block.digest(at, length, 0), (block.digest(at, length, 1) >> np.uint64(56)).astype(np.uint8))

    def ask_long(self, block: Block, sampled: np.ndarray) -> tuple[np.ndarray, Names]:
        at = sampled[sampled + self.long <= block.ends[block.document_of(sampled)]]
        return at, self._names(block, at, self.long)

    def _starts(self, block: Block, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a position lies in one of the closed intervals and begins a whole string of its document."""
        edges = np.zeros(len(block.data) + 2, np.int32)
        np.add.at(edges, low, 1)
        np.add.at(edges, high + 1, -1)
        inside = np.cumsum(edges)[: len(block.data)] > 0
        for e, n in zip(block.ends.tolist(), block.lengths.tolist(), strict=True):
            inside[max(e - n, e - self.length + 1) : e] = False
        return inside

    def _possible(self, block: Block, sampled: np.ndarray) -> np.ndarray:
        begin = block.starts[block.document_of(sampled)]
        return self._starts(block, np.maximum(sampled - self.modulus + 1, begin), sampled)

    def _proven(self, block: Block, sampled: np.ndarray, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Starts proven to be repeated, and those of them that this block stands for."""
        at, names = self.ask_long(block, sampled)
        again, first = _bits(answers, 1, len(names.high))
        repeated = again | names.twice
        proven_at, own_at = at[repeated[names.which]], at[(repeated & first)[names.which]]
        return (
            self._starts(block, proven_at, proven_at + self.modulus - 1),
            self._starts(block, own_at, own_at + self.modulus - 1),
        )

    def ask_open(self, block: Block, sampled: np.ndarray, answers: pd.DataFrame) -> tuple[Names, np.ndarray]:
        """Names of the sampled tuples, and which of them lie near a start that is neither proven nor ruled out."""
        proven, _ = self._proven(block, sampled, answers)
        open_before = np.concatenate([[0], np.cumsum(self._possible(block, sampled) & ~proven)])
        begin = block.starts[block.document_of(sampled)]
        near = open_before[sampled + 1] > open_before[np.maximum(sampled - self.modulus + 1, begin)]
        names = self._sample_names(block, sampled)
        return names, np.bincount(names.which, near, minlength=len(names.high)) > 0

    def ask_rest(self, block: Block, sampled: np.ndarray, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, Names]:
        """Proven starts, the starts asked about, and their names.

        Besides the open starts a block names the proven ones that it stands for,
        where a tuple near them lies near an open start of any block.
        """
        proven, own = self._proven(block, sampled, answers)
        names = self._sample_names(block, sampled)
        wanted, _ = _bits(answers, 3, len(names.high))
        asked = np.flatnonzero((self._possible(block, sampled) & ~proven) | (own & self._possible(block, sampled[wanted[names.which]])))
        return proven, asked, self._names(block, asked, self.length)

    def spans(self, block: Block, sampled: np.ndarray, answers: pd.DataFrame) -> Iterator[tuple]:
        proven, asked, names = self.ask_rest(block, sampled, answers)
        again, _ = _bits(answers, 2, len(names.high))
        proven[asked[(again | names.twice)[names.which]]] = True
        at = np.flatnonzero(proven)
        edges = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + self.length, -1)
        gone = np.cumsum(edges)[: len(block.data)] > 0
        raw = np.frombuffer(block.data, np.uint8)
        for row, s, e in zip(block.rows.tolist(), block.starts.tolist(), block.ends.tolist(), strict=True):
            mine = gone[s:e]
            change = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            kept = hashlib.sha256(raw[s:e][~mine].tobytes()).hexdigest()
            yield row, e - s, int(mine.sum()), change.reshape(-1, 2).tolist(), kept


_RESULT = "__row bigint, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, kept_sha256 string"
_MIXED = "block bigint, turn int, bucket int, data binary, at binary, __row bigint, n_bytes bigint, kept_sha256 string"


def _mixed(rows: list[dict]) -> pd.DataFrame:
    names = ["block", "turn", "bucket", "data", "at", "__row", "n_bytes", "kept_sha256"]
    frame = pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)
    return frame.astype({n: "Int64" for n in ("block", "turn", "bucket", "__row", "n_bytes")})


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, Block]]:
    part = TaskContext.get().partitionId()
    for n, group in enumerate(by_size(rows_of(batches, "__row", "__text"), lambda r: len(r[1]), size)):
        raw = [r[1].encode("utf-8", "surrogatepass") for r in group]
        yield (part << 32) | n, Block(np.array([r[0] for r in group]), np.array([len(r) for r in raw]), b"".join(raw))


def repeated_spans(docs: DataFrame, length: int = 200, block_chars: int = 2_000_000) -> DataFrame:
    """__row, doc_id, n_bytes, n_removed, spans (start, end of each maximal removed run) and kept_sha256.

    One row for each input row.  A byte goes if a string of ``length`` bytes over
    it begins anywhere else too; strings never cross documents, and a null text
    is empty.  Rows that repeat a text count as separate places.  ``docs`` must
    read the same rows each time; blocks whose names changed end the job.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.select("doc_id", text_of().alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    slim = numbered.select("__row", "__text")
    search = Search(length)

    def ask(batches):
        for block, content in _blocks(batches, block_chars):
            _, names = search.ask_sample(content)
            found = list(names.messages(buckets))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(found), pa.int64()),
                    pa.array([0] * len(found), pa.int32()),
                    pa.array([b for b, _ in found], pa.int32()),
                    pa.array([x for _, x in found], pa.binary()),
                ],
                ["block", "turn", "bucket", "data"],
            )

    def pack(batches):
        for block, content in _blocks(batches, block_chars):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([content.packed()], pa.binary())], ["block", "data"])

    def sift(_key, left, right):
        """Documents without a repeated sample are done; the others go on with their samples' new names."""
        out = []
        for block, raw in zip(left["block"], left["data"], strict=True):
            content = Block.unpacked(raw)
            at, names = search.ask_sample(content)
            again, _ = _bits(right, 0, len(names.high))
            at = at[(again | names.twice)[names.which]]
            holds = np.zeros(len(content.rows), bool)
            holds[content.document_of(at)] = True
            for i in np.flatnonzero(~holds):
                kept = content.data[content.starts[i] : content.ends[i]]
                out.append({"__row": int(content.rows[i]), "n_bytes": len(kept), "kept_sha256": hashlib.sha256(kept).hexdigest()})
            if holds.any():
                rest = content.part(np.flatnonzero(holds))
                moved = np.zeros(len(content.rows), np.int64)
                moved[holds] = rest.starts - content.starts[holds]
                at = np.sort(at + moved[content.document_of(at)])
                steps = zstandard.ZstdCompressor(level=3).compress(np.diff(at, prepend=0).astype("<u4").tobytes())
                out.append({"block": block, "turn": -1, "data": rest.packed(), "at": steps})
                _, names = search.ask_long(rest, at)
                out += [{"block": block, "turn": 1, "bucket": b, "data": x} for b, x in names.messages(buckets)]
        return _mixed(out)

    def carried(left):
        for block, raw, steps in zip(left["block"], left["data"], left["at"], strict=True):
            at = np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(steps), "<u4").astype(np.int64))
            yield block, Block.unpacked(raw), at

    def ask_open(_key, left, right):
        out = []
        for block, content, at in carried(left):
            names, flags = search.ask_open(content, at, right)
            out += [(block, 3, b, x) for b, x in names.messages(buckets, flags)]
        return pd.DataFrame(out, columns=["block", "turn", "bucket", "data"])

    def ask_rest(_key, left, right):
        out = []
        for block, content, at in carried(left):
            _, _, names = search.ask_rest(content, at, right)
            out += [(block, 2, b, x) for b, x in names.messages(buckets)]
        return pd.DataFrame(out, columns=["block", "turn", "bucket", "data"])

    def finish(_key, left, right):
        out = [r for _, content, at in carried(left) for r in search.spans(content, at, right)]
        return pd.DataFrame(out, columns=["__row", "n_bytes", "n_removed", "spans", "kept_sha256"])

    message = "block bigint, turn int, bucket int, data binary"
    together = lambda left, right: left.groupBy("block").cogroup(right.groupBy("block"))
    first = _answers(slim.mapInArrow(ask, message))
    # bucketed by block, so that the blocks are not shuffled again in the turns below
    store = f"suffix_blocks_{uuid.uuid4().hex}"
    packed = slim.mapInArrow(pack, "block bigint, data binary")
    try:
        together(packed, first).applyInPandas(sift, _MIXED).write.bucketBy(buckets, "block").saveAsTable(store)
        sifted = spark.table(store)
        blocks = sifted.where("turn = -1").select("block", "data", "at")
        answers = cut_lineage(_answers(sifted.where("turn = 1").select("block", "turn", "bucket", "data")))
        answers = answers.unionByName(cut_lineage(_answers(together(blocks, answers).applyInPandas(ask_open, message), _answer_any)))
        answers = answers.unionByName(cut_lineage(_answers(together(blocks, answers).applyInPandas(ask_rest, message))))
        done = together(blocks, answers).applyInPandas(finish, _RESULT)
        whole = sifted.where(F.col("__row").isNotNull()).select(
            "__row", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"), F.array().cast("array<array<bigint>>").alias("spans"), "kept_sha256"
        )
        results = cut_lineage(whole.unionByName(done))
    finally:
        spark.sql(f"drop table if exists {store}")
    ids = numbered.select(F.col("__row").alias("__of"), "doc_id")
    return ids.join(results, F.col("__row") == F.col("__of")).select("__row", "doc_id", "n_bytes", "n_removed", "spans", "kept_sha256")


def repeat_digest(docs: DataFrame) -> DataFrame:
    """How much of every document is removed, in how many runs, and the digest of what stays."""
    return repeated_spans(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
