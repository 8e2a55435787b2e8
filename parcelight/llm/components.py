"""Connected components by alternating stars, in joins and aggregates.

A large star links every larger neighbour of a node to the smallest node it
knows, a small star the smaller ones; both keep the components and let every
node reach its smallest member in a logarithmic number of turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.session import cut_lineage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, most_turns: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node of its component.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    current = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    before = _mark(current)
    for _ in range(most_turns):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = large.join(least, F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut_lineage(small.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct())
        after = _mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
