"""The LSH forest: matched prefixes, their shortening on the data, and recall against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.llm import common, near_duplicates
from tests.llm.test_text_operators import brute_links, by_id, frame


def stored(spark, tmp_path, texts):
    common.prepared(spark)
    path = str(tmp_path / "t")
    frame(spark, [(i, t, "en", "a") for i, t in texts.items()]).write.parquet(path)
    return spark.read.parquet(path)


def pairs(n, changed, seed=3):
    """Pairs of texts of 200 words that differ in some words of the second; ids 2i and 2i + 1."""
    rng = random.Random(seed)
    texts = {}
    for i in range(n):
        words = [f"p{i}w{rng.randrange(10**6)}" for _ in range(200)]
        other = list(words)
        for k in range(changed):
            other[5 + k * 20] = f"new{i}x{k}"
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(other)
    return texts


def forest(docs, deepest=8, shortest=5):
    numbered = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    nodes = near_duplicates.signatures(numbered, 24, deepest, 17).where(F.col("node").isNotNull()).dropDuplicates(["node"])
    nodes = nodes.select("node", "forest").cache()
    return nodes, near_duplicates.trie_neighbours(nodes, 24, deepest, shortest).cache()


def test_neighbours_are_the_longest_prefixes(spark, tmp_path):
    """Each node's longest match in each tree equals that over all pairs, whatever the ranges."""
    docs = stored(spark, tmp_path, pairs(12, 4))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes, neighbours = forest(docs, shortest=1)
        found = {}
        for r in neighbours.collect():
            for node in (r.node, r.prior):
                key = (bytes(node), r.tree)
                found[key] = max(found.get(key, 0), r.common)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    values = {bytes(r.node): np.frombuffer(r.forest, np.uint16).reshape(24, 8) for r in nodes.collect()}
    wanted = {}
    for a, b in combinations(values, 2):
        for tree, n in enumerate(np.cumprod(values[a] == values[b], axis=1).sum(axis=1)):
            for node in (a, b):
                if n:
                    wanted[node, tree] = max(wanted.get((node, tree), 0), int(n))
    assert found == wanted


@pytest.mark.parametrize(("changed", "weak"), [(1, False), (4, True)])
def test_prefixes_get_shorter_where_links_are_weak(spark, tmp_path, changed, weak):
    """Whole paths do for strong links; weak ones shorten the prefixes until every linked node is tied."""
    texts = pairs(120, changed)
    _, neighbours = forest(stored(spark, tmp_path, texts))
    depth = near_duplicates.matched_depth(neighbours, 24, 8, 5, 0.9999)
    assert (depth < 8) == weak
    ties = neighbours.where(F.col("common") >= depth)
    assert ties.select("node").union(ties.select("prior")).distinct().count() == len(texts)


def test_shown_recall():
    assert near_duplicates.shown_recall(0, 0, 0) == 1.0
    assert near_duplicates.shown_recall(0, 9, 40) == 1.0
    assert near_duplicates.shown_recall(1, 0, 1) < near_duplicates.shown_recall(1, 9, 40) < 0.9999
    assert near_duplicates.shown_recall(2, 40, 10**7) > 0.9999


def test_recall_at_the_weakest_similarity(spark, tmp_path):
    """200 pairs at 0.815: every link that all pairs give is found, none more."""
    texts = pairs(200, 4)
    links, classes = brute_links(texts)
    assert sum(links.values()) == 400
    found = by_id(near_duplicates.near_duplicates(stored(spark, tmp_path, texts)))
    assert sum(r.n_links for r in found.values()) >= 0.995 * sum(links.values())
    assert all(r.n_links <= links[i] for i, r in found.items())
    assert all(r.class_id == classes[i] for i, r in found.items() if r.n_links)


def test_no_nodes(spark, tmp_path):
    docs = stored(spark, tmp_path, {1: "", 2: None})
    _, neighbours = forest(docs)
    assert neighbours.count() == 0
    assert near_duplicates.matched_depth(neighbours, 24, 8, 5, 0.9999) == 8
