import random

import pytest
from pyspark.sql import functions as F

from parcelight.operators.prefix import prior_totals, with_position


def _rows(seed):
    """One key holds half of all rows, and one moment a third of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}"
        moment = 7 if rng.random() < 0.33 else rng.randrange(50)
        rows.append((key, moment, i, rng.choice([0, 1, 5, None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_keyed_totals_equal_a_sequential_pass(spark, blocks):
    rows = _rows(blocks)
    frame = spark.createDataFrame(rows, "k string, t int, id int, v int")
    got = prior_totals(
        frame, ["t", "id"], {"n": F.lit(1), "s": F.col("v")}, partition_by=["k"], blocks=blocks
    )
    seen, expected = {}, {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        expected[i] = seen.get(k, (0, 0))
        n, s = expected[i]
        seen[k] = (n + 1, s + (v or 0))
    assert {r["id"]: (r["n"], r["s"]) for r in got.collect()} == expected


@pytest.mark.parametrize("blocks", [1, 7])
def test_positions_number_all_rows(spark, blocks):
    rows = _rows(99)
    frame = spark.createDataFrame(rows, "k string, t int, id int, v int")
    got = {r["id"]: r["position"] for r in with_position(frame, ["t", "id"], blocks=blocks).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert got == {r[2]: p for p, r in enumerate(order)}


def test_empty_input_and_null_keys(spark):
    empty = spark.createDataFrame([], "k string, t int")
    assert prior_totals(empty, ["t"], {"n": F.lit(1)}, ["k"]).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), (None, 3)], "k string, t int")
    got = prior_totals(nulls, ["t"], {"n": F.lit(1)}, ["k"], blocks=3).collect()
    assert sorted((r["k"] or "", r["t"], r["n"]) for r in got) == [("", 1, 0), ("", 2, 1), ("", 3, 2), ("a", 1, 0)]


def test_a_hot_key_is_spread_over_blocks(spark):
    """The window that adds up rows is partitioned by block as well as by key,
    and only block carries are broadcast."""
    frame = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id"))
    plan = prior_totals(frame, ["id"], {"n": F.lit(1)}, ["k"], blocks=8)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "__block" in text and "SinglePartition" not in text
    blocks = frame.repartitionByRange(8, "k", "id").select(F.spark_partition_id().alias("b")).distinct().count()
    assert blocks == 8
