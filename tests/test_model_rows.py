"""What training reads is built with few shuffles and sorts."""

import re

import pytest
from pyspark.sql import functions as F

from parcelight.operators import orders
from parcelight.operators import statistics as stats
from parcelight.operators.prefix import in_blocks, prior_totals_in_blocks
from parcelight.registry import modeling as registry
from parcelight.session import hash_joins

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _star(spark, kind="int"):
    items = spark.range(4000).selectExpr(
        "id div 4 as order_id", f"cast(id % 4 + 1 as {kind}) as order_item_id", "id % 50 as product_id",
        "id % 7 as seller_id", "1.5D as price", "0.5D as freight_value",
    )
    products = spark.range(50).selectExpr("id as product_id", "concat('c', id % 5) as product_category_name")
    sellers = spark.range(7).selectExpr("id as seller_id", "concat('s', id % 3) as seller_state")
    return items, products, sellers


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_item_numbers_of_any_size_count_once(spark, kind):
    numbers = {1: [0, 63, 63, None], 2: [-1, 64, 64, 5, 127], 3: [None], 4: [1000, -64, 2**31 - 1], 5: [1, 2, 2]}
    rows = [(o, n, 1, 1, 2.0, 1.0) for o, ns in numbers.items() for n in ns]
    items = spark.createDataFrame(
        rows, "order_id long, order_item_id int, product_id long, seller_id long, price double, freight_value double"
    ).withColumn("order_item_id", F.col("order_item_id").cast(kind))
    _, products, sellers = _star(spark)
    rolled = orders.item_rollup(items, products, sellers)
    assert dict(rolled.dtypes)["n_items"] == "bigint"
    assert {r["order_id"]: r["n_items"] for r in rolled.collect()} == {o: len({*ns} - {None}) for o, ns in numbers.items()}


def test_lines_are_shuffled_once_for_their_sums(spark):
    """The lines of an order with usual numbers do not travel by number."""
    assert "hashpartitioning(order_id" in (text := _final_plan(orders.item_rollup(*_star(spark))))
    assert not re.search(r"hashpartitioning\(order_id#\d+L?, order_item_id", text)


def test_wide_rows_are_not_shuffled_to_the_customers(spark, no_broadcast):
    bought = spark.range(1000).selectExpr(
        "id as order_id", "id % 90 as customer_id", "'delivered' as order_status",
        "timestamp_ntz'2024-01-01' as order_purchase_timestamp", "timestamp_ntz'2024-01-05' as order_delivered_customer_date",
        "timestamp_ntz'2024-01-04' as order_estimated_delivery_date",
    )
    customers = spark.range(90).selectExpr("id as customer_id", "'s1' as customer_state", "'x' as customer_city")
    made = orders.order_features(bought, *_star(spark), customers)
    assert made.count() == 1000
    lines = _final_plan(made).split("\n")
    sent = [lines[n + 1] for n, line in enumerate(lines) if "Exchange hashpartitioning(customer_id" in line]
    assert len(sent) == 2 and not any("raw_price" in line for line in sent)


def test_joins_hash_small_partitions(spark, no_broadcast):
    left = spark.range(2000).withColumn("a", F.col("id") * 2)
    right = spark.range(1000).withColumn("b", F.col("id") + 1)
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name, None)
    with hash_joins(spark):
        hashed = left.join(right, "id")
        assert "ShuffledHashJoin" in _final_plan(hashed) and hashed.count() == 1000
    assert spark.conf.get(name, None) == before
    assert "SortMergeJoin" in _final_plan(left.join(right, "id"))


def test_model_rows_are_joined_by_hash(spark, monkeypatch, no_broadcast):
    seen = []
    monkeypatch.setattr(registry, "dataset", lambda i: spark.range(1))
    monkeypatch.setattr(
        registry, "_parts", lambda *_: seen.append(spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"))
    )
    registry._model_parts(type("I", (), {"spark": spark}))
    assert seen == ["64MB"]


def test_a_key_is_sorted_by_itself_before_its_block(spark):
    frame = spark.range(500).selectExpr("id % 9 as k", "id as t", "1L as v")
    blocked = in_blocks(frame, ["t"], ["k"])
    made = prior_totals_in_blocks(blocked, ["t"], {"n": F.col("v")}, ["k"], keys_first=True)
    assert re.search(r"Sort \[k#\d+L? ASC NULLS FIRST, __block#\d+ ASC NULLS FIRST, t#", _final_plan(made))
    assert {(r["t"], r["n"]) for r in made.collect()} == {(i, i // 9) for i in range(500)}


def test_training_rows_are_digested_once(spark, monkeypatch, tmp_path):
    train = spark.createDataFrame([(i, i % 2, float(i % 5)) for i in range(40)], "order_id long, target_late int, x double")
    counted, digest = [], registry._digest
    monkeypatch.setattr(registry, "_digest", lambda df: counted.append(1) or digest(df))
    monkeypatch.setattr(registry.modeling, "save_model", lambda *_: None)
    monkeypatch.setattr(registry.modeling, "load_model", lambda *_: (None, {}))
    registry._saved(type("I", (), {"spark": spark}), "digest-test", lambda df: None, train)
    assert len(counted) == 1


def test_the_sketch_is_as_fine_as_the_range_needs(spark):
    """Its error stays inside the range around the middle, and one task merges no finer one."""
    assert 1 < stats._SKETCH_ACCURACY * stats._NEAR_MIDDLE <= 2
    numbers = spark.range(0, 30_001, 1, 12).select((F.col("id") * 7919 % 30_011).cast("double").alias("x"))
    ordered = sorted(r["x"] for r in numbers.collect())
    assert [tuple(r) for r in stats.exact_medians(numbers, ["x"]).collect()] == [("x", ordered[15_000])]
