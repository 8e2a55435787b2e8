from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelight.functions.numbers import money_sum, round_half_up
from parcelight.operators import history, orders
from parcelight.plans import dashboard, modeling

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def star(spark):
    """Order 1 has two sellers and two reviews, order 2 a free item, order 3 no
    items, order 4 is canceled."""
    day = timedelta(days=1)
    order_rows = [
        (1, 10, "delivered", T0, T0 + 5 * day, T0 + 4 * day),
        (2, 10, "delivered", T0 + day, T0 + 3 * day, T0 + 9 * day),
        (3, 11, "delivered", T0 + 2 * day, T0 + 3 * day, T0 + 9 * day),
        (4, 11, "canceled", T0 + 3 * day, None, None),
    ]
    return {
        "orders": spark.createDataFrame(
            order_rows,
            "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz,"
            " order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ),
        "items": spark.createDataFrame(
            [(1, 1, 100, 7, 10.0, 1.0), (1, 2, 101, 8, 30.0, 6.0), (1, 2, 101, 8, 30.0, 6.0),
             (2, 1, 100, 7, 0.0, 5.0), (4, 1, 101, 8, 20.0, 2.0)],
            "order_id long, order_item_id int, product_id long, seller_id long, price double, freight_value double",
        ),
        "products": spark.createDataFrame([(100, None), (101, "toys")], "product_id long, product_category_name string"),
        "sellers": spark.createDataFrame([(7, "SP"), (8, "RJ")], "seller_id long, seller_state string"),
        "customers": spark.createDataFrame(
            [(10, "SP", "a"), (11, "RJ", "b")], "customer_id long, customer_state string, customer_city string"
        ),
    }


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame([(1, 1, 5), (2, 1, 2), (3, 4, 1)], "review_id long, order_id long, review_score int")


def _by_order(df):
    return {r["order_id"]: r for r in df.collect()}


def test_features(star):
    got = _by_order(orders.order_features(**star))
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one["n_items"], one["total_price"], one["total_freight"]) == (2, 70.0, 13.0)
    assert one["freight_to_price_ratio"] == round((0.1 + 0.2 + 0.2) / 3, 4)
    assert (one["cross_state"], one["product_category"], one["target_late"]) == (1, "toys", 1)
    assert (two["freight_to_price_ratio"], two["cross_state"], two["product_category"]) == (None, 0, "unknown")


def test_small_amounts_are_not_lost(spark):
    lines = spark.range(100_000).select(F.lit(0.00004).alias("price"))
    total = lines.agg(round_half_up(money_sum(F.col("price")), 2).alias("total")).first()["total"]
    assert total == 4.0


def test_building_a_mart_starts_no_job(spark, star):
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        orders.order_features(**star)
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_category_rules(spark, star):
    products = spark.createDataFrame([(100, "art"), (101, "toys")], "product_id long, product_category_name string")
    parts = {**star, "products": products}
    assert _by_order(orders.order_features(**parts))[1]["product_category"] == "art"
    assert _by_order(orders.order_features(**parts, category_rule="mode"))[1]["product_category"] == "toys"
    with pytest.raises(ValueError):
        orders.order_features(**parts, category_rule="best")


def test_mart_and_fanout(star, reviews):
    mart = _by_order(orders.order_mart(**star, reviews=reviews))
    fan = _by_order(orders.order_mart_fanout(**star, reviews=reviews))
    assert set(mart) == {1, 2, 4}
    assert (mart[1]["total_price"], fan[1]["total_price"]) == (70.0, 140.0)
    assert mart[1]["avg_review_score"] == fan[1]["avg_review_score"] == 3.5
    assert (mart[2]["avg_review_score"], fan[2]["total_freight"]) == (0.0, 5.0)
    assert (mart[4]["is_late"], mart[4]["delivery_days"], mart[4]["product_category"]) == (0, None, "toys")


def test_payments(spark, star):
    payments = spark.createDataFrame(
        [(1, "voucher", 1), (1, "boleto", 6)], "order_id long, payment_type string, payment_installments int"
    )
    got = _by_order(orders.payment_features(star["orders"].select("order_id"), payments))
    assert (got[1]["payment_type"], got[1]["payment_installments"]) == ("boleto", 6)
    assert (got[2]["payment_type"], got[2]["payment_installments"]) == ("unknown", 1)


def test_lists(star):
    one = _by_order(orders.order_lists(star["items"], star["products"], star["sellers"]))[1]
    assert (one["seller_ids"], one["categories"], one["seller_states"]) == ([7, 8], ["toys"], ["RJ", "SP"])
    assert one["several_states"] and one["first_category"] == "toys"


def test_history_equals_a_sequential_pass(inputs):
    """The windows give what reading the orders one by one gives."""
    delivered = orders.delivered_orders(inputs.shop_orders)
    late = {
        r[0]: (r[1], int(r[2]))
        for r in delivered.select(
            "order_id", "order_purchase_timestamp",
            F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"),
        ).collect()
    }
    sellers = {}
    for r in inputs.shop_items.select("order_id", "seller_id").distinct().collect():
        sellers.setdefault(r[0], set()).add(r[1])
    own, everyone, expected = {}, [0, 0], {}
    for order in sorted((o for o in late if o in sellers), key=lambda o: (late[o][0], o)):
        rates = []
        for s in sellers[order]:
            n, bad = own.get(s, (0, 0))
            source = (n, bad) if n >= 3 else everyone
            rates.append(source[1] / source[0] if source[0] >= 3 else 0.0)
        expected[order] = sum(rates) / len(rates)
        for s in sellers[order]:
            n, bad = own.get(s, (0, 0))
            own[s] = (n + 1, bad + late[order][1])
            everyone[0] += 1
            everyone[1] += late[order][1]
    got = _by_order(history.seller_hist_late_rate(inputs.shop_orders, inputs.shop_items))
    assert set(got) == set(expected)
    assert all(abs(got[o]["seller_hist_late_rate"] - expected[o]) < 1e-12 for o in got)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 101])
def test_split_sizes(spark, n):
    frame = spark.range(n).select(F.col("id").alias("order_id"))
    parts = [r["part"] for r in history.time_split(frame, ["order_id"]).orderBy("order_id").collect()]
    assert parts == ["train"] * int(0.8 * n) + ["test"] * (n - int(0.8 * n))


def test_the_two_ways_to_split_agree(spark, inputs):
    frame = orders.delivered_orders(inputs.shop_orders).select("order_id", "order_purchase_timestamp")
    by = ["order_purchase_timestamp", "order_id"]
    split = history.time_split(frame, by).where("part = 'train'").select("order_id").collect()
    early = frame.where(history.is_train(frame, by)).select("order_id").collect()
    assert sorted(split) == sorted(early) and len(early) == int(0.8 * frame.count())
    assert frame.limit(0).where(history.is_train(frame.limit(0), by)).count() == 0


def test_light_frame_and_what_if(star, reviews):
    mart = orders.order_mart(**star, reviews=reviews)
    light = _by_order(modeling.light_model_dataset(mart))
    assert set(light) == {1, 2}
    assert light[1]["seller_hist_late_rate"] == pytest.approx(1 / 3)
    assert "payment_type" not in light[1]


def test_dashboard_filters(star, reviews):
    mart = orders.order_mart(**star, reviews=reviews)
    assert dashboard.filter_orders(mart).count() == 3
    assert dashboard.filter_orders(mart, states=["SP"]).count() == 2
    assert dashboard.filter_orders(mart, first=T0.date(), last=T0.date()).count() == 1
    assert dashboard.filter_orders(mart, states=[]).count() == 0
    assert dashboard.filter_orders(mart, states=dashboard.preselected_states(mart, 1)).count() == 1
    assert dashboard.nothing_selected(dashboard.filter_orders(mart, states=["nowhere"]))
    assert [r[0] for r in dashboard.value_list(mart, "customer_state").collect()] == ["RJ", "SP"]
    kpi = dashboard.kpi_overview(dashboard.delivered_only(mart)).first()
    assert (kpi["avg_review"], kpi["avg_review_reviewed"], kpi["total_revenue"]) == (1.75, 3.5, 70.0)
    assert dashboard.late_rate_by(mart, "customer_state", 2).count() == 1
