"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact comparison decides.

Texts with the same words in the same order are copies and form one node.  Each
tree of the forest gives a node a path of MinHash values of its five-word
shingles.  Paths are sorted, so that a tree lies in the table as a prefix trie:
neighbours in the order share the longest prefixes there are, and the nodes
under a prefix of any length follow each other.  One pass over the order finds
how long a prefix each node matches in each tree.

Matched prefixes then get shorter, from whole paths on, until the data show the
target recall: among nodes that few trees tie, the numbers tied by one and by
two trees tell how many no tree ties.  At the length at which the settings alone
assure the recall for the weakest pair asked for, shortening ends.

Neighbours with such a prefix are tied, so a prefix that holds any number of
nodes makes as many ties.  Within a component of ties every pair that sizes
allow is compared by its shingle sets: small components whole, large ones as
blocks against blocks, each pair of blocks in a task of its own.  Counts and a
spanning set of links leave a task, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from parcelight.llm.common import by_size, rows_of, set_apart, text_of
from parcelight.llm.components import connected
from parcelight.operators.prefix import prior_totals
from parcelight.session import cut_lineage

SHINGLE = 5
VALUE_BYTES = 2  # of a MinHash value in a path; values that differ agree in these once in 65,536
_CACHED_WORDS = 400_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def recall(similarity: float, depth: int, trees: int) -> float:
    """Chance that a pair shares a prefix of this depth in at least one tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(similarity: float, trees: int, deepest: int, target: float) -> int:
    """The longest prefix that assures the target recall whatever the data hold; matched prefixes get no shorter."""
    depth = deepest
    while depth > 1 and recall(similarity, depth, trees) < target:
        depth -= 1
    return depth


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(texts: list[str], known: _WordHashes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Word digest of each text, hashes of its shingles one after the other, and how many each has.

    A text of fewer than five words has one shingle, all its words; one without words has none.
    """
    if len(known) > _CACHED_WORDS:
        known.clear()
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    digests = [xxhash.xxh3_128_digest(b" ".join(w)) for w in words]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(known.__getitem__, w)), np.uint64, int(sizes.sum()))
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    padded = np.concatenate([flat, np.zeros(SHINGLE, np.uint64)])
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(flat))
    mixed = np.zeros(len(flat), np.uint64)
    for k, factor in enumerate(_FACTORS):
        mixed += np.where(at + k < ends, padded[k : k + len(flat)], np.uint64(0)) * factor
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = mixed[at - first < np.repeat(counts, sizes)]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x7FB5D329728EA185)
    mixed ^= mixed >> np.uint64(27)
    mixed *= np.uint64(0x81DADEF4BC2DD44D)
    mixed ^= mixed >> np.uint64(33)
    return digests, mixed, counts


def forest_paths(shingles: np.ndarray, counts: np.ndarray, trees: int, depth: int, seed: int) -> np.ndarray:
    """MinHash values of every text that has shingles: (texts, trees, depth)."""
    rng = np.random.default_rng(seed)
    n = trees * depth
    flips = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    factors = rng.integers(0, 1 << 31, n, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), n), np.uint16)
    for j in range(n):
        # the least values are small, so their low bits tell them apart
        out[:, j] = np.minimum.reduceat((short ^ flips[j]) * factors[j], starts)
    return out.reshape(len(counts), trees, depth)


def signatures(docs: DataFrame, trees: int, depth: int, seed: int) -> DataFrame:
    """__row, doc_id, node (digest of the words, null without words), size (distinct shingles), forest (the paths, one after the other)."""
    slim = docs.select("__row", "doc_id", text_of().alias("__text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            for group in by_size(rows_of(iter([batch]), "__row", "doc_id", "__text"), lambda r: len(r[2]), 1_000_000):
                digests, shingles, counts = shingle_hashes([r[2] for r in group], known)
                sets = [np.unique(s) for s in np.split(shingles, np.cumsum(counts)[:-1])]
                counts = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(counts)
                keys: list = [None] * len(group)
                if len(some):
                    paths = forest_paths(np.concatenate(sets), counts[some], trees, depth, seed)
                    for n, i in enumerate(some):
                        keys[i] = paths[n].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in group], pa.int64()),
                        pa.array([r[1] for r in group], batch.schema.field("doc_id").type),
                        pa.array([d if c else None for d, c in zip(digests, counts, strict=True)], pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array(keys, pa.binary()),
                    ],
                    ["__row", "doc_id", "node", "size", "forest"],
                )

    return slim.mapInArrow(run, f"__row bigint, doc_id {id_type}, node binary, size bigint, forest binary")


def trie_neighbours(nodes: DataFrame, trees: int, deepest: int, shortest: int) -> DataFrame:
    """tree, node, prior, common: each node with the one before it in a tree's order, and how many values they share.

    Pairs that share fewer than ``shortest`` values are left out.  The order is cut into ranges by tree, path and
    node, so equal paths spread over tasks; the pair at a border comes from the two rows beside it, two for each range.
    """
    width = VALUE_BYTES * deepest
    keyed = nodes.select("node", "forest", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select(
        "tree", F.expr(f"substring(forest, tree * {width} + 1, {width})").alias("path"), "node"
    )
    ordered = keyed.repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()

        def told(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*rows, strict=True)
            names = ["tree", "node", "prior", "common", "place", "path"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        last: tuple | None = None
        for batch in batches:
            held = [batch.column(i).to_pylist() for i in range(3)]
            if not held[0]:
                continue
            if last is None:
                yield told([(held[0][0], held[2][0], None, None, 2 * block, held[1][0])])
            else:
                held = [[x, *column] for x, column in zip(last, held, strict=True)]
            tree = np.array(held[0])
            values = np.frombuffer(b"".join(held[1]), np.uint16).reshape(-1, deepest)
            common = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1) * (tree[1:] == tree[:-1])
            ties = [(held[0][i + 1], held[2][i + 1], held[2][i], int(common[i]), None, None) for i in np.flatnonzero(common >= shortest)]
            if ties:
                yield told(ties)
            last = tuple(column[-1] for column in held)
        if last is not None:
            yield told([(last[0], last[2], None, None, 2 * block + 1, last[1])])

    passed = cut_lineage(ordered.mapInArrow(run, "tree int, node binary, prior binary, common int, place int, path binary"))
    # the first and the last row of each range, so its order needs no more rows than that
    over = Window.orderBy("place")
    ends = passed.where(F.col("place").isNotNull()).select(
        "tree", "node", "place", "path", F.lag("tree").over(over).alias("__tree"), F.lag("node").over(over).alias("prior"), F.lag("path").over(over).alias("__path")
    )
    shared = sum((F.substring("path", 1, n) == F.substring("__path", 1, n)).cast("int") for n in range(VALUE_BYTES, width + 1, VALUE_BYTES))
    borders = ends.where((F.col("place") % 2 == 0) & (F.col("tree") == F.col("__tree"))).select("tree", "node", "prior", shared.alias("common"))
    return passed.where(F.col("place").isNull()).select("tree", "node", "prior", "common").unionByName(borders.where(F.col("common") >= shortest))


def tied_by(neighbours: DataFrame, trees: int, depths: range) -> Row:
    """One row: for each length d of a prefix, the nodes that one tree ties (``one_d``), two (``two_d``), a third of all or fewer (``few_d``)."""
    ends = neighbours.select("tree", "node", "common").unionByName(neighbours.select("tree", F.col("prior").alias("node"), "common"))
    longest = ends.groupBy("node", "tree").agg(F.max("common").alias("longest"))
    held = longest.groupBy("node").agg(*[F.sum((F.col("longest") >= d).cast("int")).alias(f"k_{d}") for d in depths])
    counts = []
    for d in depths:
        k = F.col(f"k_{d}")
        for name, hit in (("one", k == 1), ("two", k == 2), ("few", (k > 0) & (k <= trees // 3))):
            counts.append(F.coalesce(F.sum(hit.cast("int")), F.lit(0)).alias(f"{name}_{d}"))
    return held.agg(*counts).first()


def shown_recall(one: int, two: int, few: int) -> float:
    """Recall among weakly tied nodes, with those that no tree ties judged by the numbers that one and two trees tie.

    Strongly tied nodes are left out, so that many copies do not hide a few links that were missed.
    """
    unseen = one * one / (2 * (two + 1))
    return 1.0 if not unseen else few / (few + unseen)


def matched_depth(neighbours: DataFrame, trees: int, deepest: int, shortest: int, target: float) -> int:
    """Length of the prefixes that tie nodes: the longest at which the data show the target recall, at least ``shortest``."""
    if deepest <= shortest:
        return shortest
    seen = tied_by(neighbours, trees, range(shortest, deepest + 1))
    depth = deepest
    while depth > shortest and shown_recall(seen[f"one_{depth}"], seen[f"two_{depth}"], seen[f"few_{depth}"]) < target:
        depth -= 1
    return depth


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """Sorted distinct shingles of each row, as bytes; the words must be those of the row's node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            for group in by_size(rows_of(iter([batch]), "node", "task", "part", "weight", "__text"), lambda r: len(r[4]), 1_000_000):
                digests, shingles, counts = shingle_hashes([r[4] for r in group], known)
                if any(d != r[0] for d, r in zip(digests, group, strict=True)):
                    raise RuntimeError("the documents changed between two reads of them")
                sets = [np.unique(s).tobytes() for s in np.split(shingles, np.cumsum(counts)[:-1])]
                columns = list(zip(*group, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.binary()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(sets, pa.binary()),
                    ],
                    ["node", "task", "part", "weight", "shingles"],
                )

    return rows.mapInArrow(run, "node binary, task string, part bigint, weight bigint, shingles binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Common shingles of all pairs, by products of a 0/1 matrix a slice of shingles at a time."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, held = np.unique(flat, return_inverse=True, return_counts=True)
    place = place.ravel()
    several = held[place] > 1
    place, owner = place[several], owner[several]
    common = np.zeros((n, n), np.float32)
    if len(place):
        _, place = np.unique(place, return_inverse=True)
        place = place.ravel()
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        for low in range(0, int(place[-1]) + 1, 4096):
            a, b = np.searchsorted(place, [low, low + 4096])
            matrix = np.zeros((n, 4096), np.float32)
            matrix[owner[a:b], place[a:b] - low] = 1
            common += matrix @ matrix.T
    return common.astype(np.int64)


def _linked(sets: list[np.ndarray], parts: np.ndarray, similarity: float) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], np.int64)
    common = shared_counts(sets)
    union = sizes[:, None] + sizes[None, :] - common
    hits = common >= similarity * union - 1e-9
    np.fill_diagonal(hits, False)
    if parts.min() != parts.max():  # blocks against each other: pairs within a block are compared in its own task
        hits &= parts[:, None] != parts[None, :]
    return hits


def _compare(similarity: float):
    def run(group):
        out: list[tuple] = []
        for _, some in group.groupby(["task", "comp"], sort=True):
            some = some.drop_duplicates("node")
            nodes, weights = some["node"].tolist(), some["weight"].to_numpy()
            hits = _linked([np.frombuffer(b, np.uint64) for b in some["shingles"]], some["part"].to_numpy(), similarity)
            links = hits @ weights
            root = list(range(len(nodes)))

            def find(i: int, root=root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, j in zip(*np.nonzero(np.triu(hits)), strict=True):
                a, b = find(int(i)), find(int(j))
                if a != b:
                    root[max(a, b)] = min(a, b)
            least: dict[int, bytes] = {}
            for i, node in enumerate(nodes):
                r = find(i)
                least[r] = min(least.get(r, node), node)
            out += [(node, int(links[i]), least[find(i)]) for i, node in enumerate(nodes) if links[i]]
        return pd.DataFrame(out, columns=["node", "links", "tied"])

    return run


def near_duplicates(
    docs: DataFrame,
    similarity: float = 0.8,
    trees: int = 24,
    deepest: int = 8,
    target_recall: float = 0.9999,
    block: int = 200,
    seed: int = 17,
) -> DataFrame:
    """doc_id, class_id, copy_id, n_links and kept, one row for each input row, with __row, its place in the read.

    ``class_id`` is the smallest id of the documents that links hold together,
    ``copy_id`` that of the documents with the same words, ``n_links`` the number
    of other documents at or above ``similarity``, copies included.  ``kept`` is
    true for one row of each class.  A text without words, null included, is a
    class of its own without links.  Rows that repeat an id are documents of
    their own; a null id sorts last.  ``docs`` must read the same rows each time,
    which is checked.
    """
    numbered = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    signed = cut_lineage(signatures(numbered, trees, deepest, seed))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    nodes = cut_lineage(
        signed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("weight"), F.first("size").alias("size"), F.first("forest").alias("forest"))
    )

    shortest = prefix_depth(similarity, trees, deepest, target_recall)
    neighbours = cut_lineage(trie_neighbours(nodes, trees, deepest, shortest))
    depth = matched_depth(neighbours, trees, deepest, shortest, target_recall)
    ties = neighbours.where(F.col("common") >= depth).select(F.col("node").alias("u"), F.col("prior").alias("v"))
    candidates = cut_lineage(
        connected(ties)
        .join(nodes.select(F.col("node").alias("__n"), "first", "weight", "size"), F.col("node") == F.col("__n"))
        .select("node", F.col("root").alias("comp"), F.col("first.__row").alias("__of"), "weight", "size")
    )

    # small components share tasks; large ones are cut into blocks of like size, which counts
    # distinct shingles as the likeness does, so that blocks too far apart hold no link
    counted = candidates.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    large = counted.where(F.col("members") > block).select(F.col("comp").alias("__large"))
    small_rows = counted.where(F.col("members") <= block).agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    shares = max(1, -(-small_rows // 400))
    alone = candidates.join(large, F.col("comp") == F.col("__large"), "left_anti").select(
        "node", "comp", "__of", "weight", F.concat(F.lit("s"), F.pmod(F.xxhash64("comp"), F.lit(shares)).cast("string")).alias("task"), F.lit(0).cast("bigint").alias("part")
    )
    ranked = prior_totals(
        candidates.join(large, F.col("comp") == F.col("__large"), "left_semi"), ["size", "node"], {"__at": F.lit(1).cast("bigint")}, partition_by=["comp"]
    ).withColumn("part", F.floor(F.col("__at") / block))
    ranked = cut_lineage(ranked)
    blocks = ranked.groupBy("comp", "part").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    other = blocks.select(F.col("comp").alias("__c"), F.col("part").alias("__p"), F.col("low").alias("__low"))
    pairs = blocks.join(other, (F.col("comp") == F.col("__c")) & (F.col("part") <= F.col("__p")) & (F.col("__low") * similarity <= F.col("high") + 1e-9))
    name = F.concat_ws(":", F.hex("comp"), F.col("part").cast("string"), F.col("__p").cast("string"))
    sides = pairs.select(F.col("comp").alias("__in"), name.alias("task"), F.explode(F.array_distinct(F.array("part", "__p"))).alias("__side"))
    blocked = ranked.join(sides, (F.col("comp") == F.col("__in")) & (F.col("part") == F.col("__side"))).select(
        "node", "comp", "__of", "weight", "task", "part"
    )

    # each candidate's text is read once and its shingles go to all its tasks
    todo = cut_lineage(alone.unionByName(blocked))
    wanted = todo.groupBy("__of").agg(F.first("node").alias("node")).select("__of", "node")
    texts = (
        numbered.join(wanted, F.col("__row") == F.col("__of"))
        .select("node", F.lit("").alias("task"), F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("weight"), text_of().alias("__text"))
    )
    sets = _shingle_sets(texts).select(F.col("node").alias("__n"), "shingles")
    compared = (
        todo.join(sets, F.col("node") == F.col("__n"))
        .select("node", "comp", "task", "part", "weight", "shingles")
        .groupBy("task")
        .applyInPandas(_compare(similarity), "node binary, links bigint, tied binary")
    )
    compared = cut_lineage(compared)
    links = compared.groupBy("node").agg(F.sum("links").alias("links")).select(F.col("node").alias("__l"), "links")
    roots = connected(compared.select(F.col("node").alias("u"), F.col("tied").alias("v"))).select(F.col("node").alias("__r"), "root")

    joined = nodes.join(links, F.col("node") == F.col("__l"), "left").join(roots, F.col("node") == F.col("__r"), "left")
    known = cut_lineage(joined.select("node", "first", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    classes = known.groupBy(F.col("root").alias("__root")).agg(F.min("first").alias("top"))
    told = known.join(classes, F.col("root") == F.col("__root")).select(
        F.col("node").alias("__n"),
        F.col("first.doc_id").alias("__copy"),
        F.col("top.doc_id").alias("__class"),
        F.col("top.__row").alias("__top"),
        (F.col("links") + F.col("weight") - 1).alias("__links"),
    )
    return signed.select("__row", "doc_id", "node").join(told, F.col("node") == F.col("__n"), "left").select(
        "__row",
        "doc_id",
        F.when(F.col("__n").isNull(), F.col("doc_id")).otherwise(F.col("__class")).alias("class_id"),
        F.when(F.col("__n").isNull(), F.col("doc_id")).otherwise(F.col("__copy")).alias("copy_id"),
        F.coalesce("__links", F.lit(0)).alias("n_links"),
        (F.col("__n").isNull() | (F.col("__row") == F.col("__top"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each class is kept, with all their columns."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("__row").alias("__kept_row"))
    inner, named = set_apart(docs)
    return inner.join(kept, F.col("__at") == F.col("__kept_row"), "left_semi").select(*named.values())
