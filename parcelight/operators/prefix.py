"""Running totals and positions over a global order, without a single hot task.

A window ordered over a whole table, or over one hot key, would put all those
rows into one task.  Here the rows are range-partitioned by (key, order), so a
hot key spreads over many blocks of similar size.  Each block is summed on its
own and gets the totals of the earlier blocks of the same key added.

A key reaches into a further block at most once per block border, so at most
``blocks - 1`` (block, key) pairs carry anything over: that list is the only
thing broadcast, and its size does not depend on the data.

Block borders come from a sample, so the blocks are checkpointed before they
are read twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.session import cut_lineage

_BLOCK = "__block"


def in_blocks(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """The rows, checkpointed, with the number of the block they fall into."""
    n_blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_blocks, *partition_by, *order_by)
    return cut_lineage(ranged.withColumn(_BLOCK, F.spark_partition_id()))


def prior_totals(
    df: DataFrame,
    order_by: Sequence[str],
    values: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Add, for every name in ``values``, its sum over strictly earlier rows.

    ``order_by`` must be unique within a key.  Values must be numeric; null
    counts as zero and the first row of a key gets zero.
    """
    blocked = in_blocks(df, order_by, partition_by, blocks)
    return prior_totals_in_blocks(blocked, order_by, values, partition_by, blocks)


def prior_totals_in_blocks(
    blocked: DataFrame,
    order_by: Sequence[str],
    values: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    blocks: int | None = None,
    keys_first: bool = False,
) -> DataFrame:
    """``prior_totals`` of rows that are in blocks of the same order already.

    ``keys_first`` sorts by key before block, which is cheaper for many number
    keys: a sort compares its first column by prefix, and a task has one block.
    """
    keys = list(partition_by)
    names = list(values)
    n_blocks = blocks or int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_block = blocked.groupBy(_BLOCK, *keys).agg(
        *[F.coalesce(F.sum(values[n]), F.lit(0)).alias(n) for n in names]
    )
    earlier_blocks = (
        Window.partitionBy(*keys)
        .orderBy(_BLOCK)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    carried = (
        per_block.select(
            F.col(_BLOCK).alias("__c_block"),
            *[F.col(k).alias(f"__c_{k}") for k in keys],
            *[F.sum(n).over(earlier_blocks).alias(f"__c_sum_{n}") for n in names],
        )
        .where(F.col(f"__c_sum_{names[0]}").isNotNull())
    )

    earlier_rows = (
        Window.partitionBy(*([*keys, _BLOCK] if keys_first else [_BLOCK, *keys]))
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    # each block goes to a task of its own
    within = blocked.repartitionById(n_blocks, _BLOCK).select(
        "*", *[F.sum(values[n]).over(earlier_rows).alias(f"__w_{n}") for n in names]
    )
    same = F.col(_BLOCK) == F.col("__c_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__c_{k}"))
    joined = within.join(F.broadcast(carried), same, "left")
    zero = F.lit(0)
    return joined.select(
        *[c for c in blocked.columns if c != _BLOCK],
        *[
            (F.coalesce(F.col(f"__w_{n}"), zero) + F.coalesce(F.col(f"__c_sum_{n}"), zero)).alias(n)
            for n in names
        ],
    )


def with_position(
    df: DataFrame, order_by: Sequence[str], name: str = "position", blocks: int | None = None
) -> DataFrame:
    """Zero-based position of every row in the global order."""
    return prior_totals(df, order_by, {name: F.lit(1).cast("bigint")}, blocks=blocks)
