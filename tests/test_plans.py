"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from parcelight.operators import orders
from parcelight.sources import sinks

EXPRESSIONS_ONLY = (
    "clean_reviews", "q4b_bottom_class_ratings", "order_mart", "order_features", "model_dataset",
    "late_rate_by_state", "chunk_reviews", "parse_extractions", "recommendations", "time_split",
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", EXPRESSIONS_ONLY)
def test_no_python_and_no_pairs_of_tables(name, spark, folder):
    text = _plan(queries()[name](spark, folder))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_scan_reads_only_what_is_used(spark, folder):
    text = _plan(queries()["late_rate_by_state"](spark, folder))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    items = next(r for r in read if "l_orderkey" in r)
    assert set(re.findall(r"(\w+):", items)) <= {"l_orderkey", "l_partkey", "l_suppkey"}


@pytest.mark.parametrize("name", ["q1_department_rating", "q4b_bottom_class_ratings"])
def test_questions_without_texts_shuffle_none(name, spark, folder):
    text = _plan(queries()[name](spark, folder))
    lines = text.split("\n")
    summed = [lines[n + 1] for n, line in enumerate(lines) if "Exchange" in line and "__digest" in line]
    assert len(summed) == 1 and "__digest" in summed[0]
    assert "Aggregate(keys" in summed[0] and "review_text" not in summed[0] and "text" not in summed[0]
    scans = [r for r in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "text:" in r]
    assert len(scans) == 1


def test_status_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.sql(
        "select 1L as order_id, 'delivered' as order_status, timestamp_ntz'2024-01-01' as order_delivered_customer_date,"
        " timestamp_ntz'2024-01-02' as order_estimated_delivery_date"
    ).write.parquet(path)
    text = _plan(orders.delivered_orders(spark.read.parquet(path)))
    assert "EqualTo(order_status,delivered)" in text


def test_lines_are_summed_before_they_are_shuffled(inputs):
    i = inputs
    for rolled in (orders.item_rollup(i.shop_items, i.shop_products, i.shop_sellers), orders.payment_rollup(i.shop_payments)):
        text = _plan(rolled)
        exchange = next(n for n, line in enumerate(text.split("\n")) if "Exchange hashpartitioning(order_id" in line)
        assert "partial_" in text.split("\n")[exchange + 1]


def test_a_hot_product_and_seller_are_split_at_run_time(spark, inputs):
    """Half of all lines name one product and one seller; with dimensions too
    big to broadcast, the skewed partitions of both joins are split."""
    spark.range(200_000).selectExpr(
        "id as order_id", "1 as order_item_id", "case when id % 2 = 0 then 1 else id % 200 + 1 end as product_id",
        "case when id % 2 = 0 then 1 else id % 10 + 1 end as seller_id", "1.0D as price", "2.0D as freight_value",
    ).createOrReplaceTempView("hot_items")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rolled = orders.item_rollup(spark.table("hot_items").repartition(4), inputs.shop_products, inputs.shop_sellers)
        rolled.collect()
        assert _plan(rolled).split("Initial Plan")[0].count("skew=true") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _gathered_rows(text):
    """Places where rows that no aggregate has summed go to one task."""
    lines = text.split("\n")
    at = [n for n, line in enumerate(lines) if "Exchange SinglePartition" in line]
    return [lines[n] for n in at if not any("Aggregate(" in x for x in lines[n + 1 : n + 5])]


def test_no_window_over_a_whole_table(spark, folder):
    for name in ("seller_hist_late_rate", "time_split", "auc_rank"):
        assert _gathered_rows(_plan(queries()[name](spark, folder))) == []
    gathered = spark.range(10).select(F.row_number().over(Window.orderBy("id")))
    assert len(_gathered_rows(_plan(gathered))) == 1


def test_bucketed_tables_roll_up_without_a_shuffle_of_items(spark, inputs):
    i = inputs
    sinks.replace_table(i.shop_items, "bucketed_items", "order_id", 8)
    sinks.replace_table(i.shop_orders, "bucketed_orders", "order_id", 8)
    rolled = orders.item_rollup(spark.table("bucketed_items"), i.shop_products, i.shop_sellers)
    joined = spark.table("bucketed_orders").hint("merge").join(rolled, "order_id")
    text = _plan(joined)
    assert "Exchange hashpartitioning(order_id" not in text
    assert joined.agg(F.count(F.lit(1))).first()[0] > 0
