import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from parcelight.functions.numbers import money_sum, round_half_up


def test_money_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(3)
    amounts = [round(rng.choice([1e-4, 1.0, 1e4, 1e9]) * rng.uniform(-1, 1), 4) for _ in range(4000)]
    rows = spark.createDataFrame([(a,) for a in amounts], "a double")
    sums = {rows.repartition(n, F.rand(n)).agg(money_sum(F.col("a"))).first()[0] for n in range(1, 11)}
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(sum(round(a * 10**4) for a in amounts) / 10**4, abs=1e-6)


def test_money_sum_of_nothing_and_of_missing_amounts(spark):
    rows = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, None), (2, None)], "k int, a double")
    got = {r["k"]: r["s"] for r in rows.groupBy("k").agg(round_half_up(money_sum(F.col("a")), 2).alias("s")).collect()}
    assert got == {1: 0.3, 2: None}


@pytest.mark.parametrize("name", ["kpi_date_range", "kpi_preselected_states"])
def test_lines_of_other_orders_are_left_out_before_the_roll_up(name, spark, folder):
    plan = queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    rolled = next(n for n, line in enumerate(plan) if "Aggregate [order_id" in line and "freight" in line or "raw_price" in line and "Aggregate" in line)
    inner = []
    for line in plan[rolled + 1 :]:
        if depth(line) <= depth(plan[rolled]):
            break
        inner.append(line)
    assert any("LeftSemi" in line for line in inner)
