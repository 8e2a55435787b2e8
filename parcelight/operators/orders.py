"""Order-grain marts over the order star.

Item lines are reduced to one row per order before they meet the orders, so the
wide order columns are never grouped on and a hot order, product or seller is
combined on the map side.  Which joins broadcast is left to Catalyst and AQE,
which check the size of the dimension and otherwise shuffle and split skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.functions.dates import (
    floor_days,
    is_late,
    weekday_number,
    whole_days,
)
from parcelight.functions.numbers import money_sum, round_half_up, safe_ratio

PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders whose delivery and promise are both known."""
    return orders.where(
        (F.col("order_status") == "delivered")
        & F.col(DELIVERED).isNotNull()
        & F.col(PROMISED).isNotNull()
    )


def delivery_days(orders: DataFrame) -> DataFrame:
    """Late flag and day counts, cut toward zero and rounded down."""
    bought, delivered, promised = F.col(PURCHASED), F.col(DELIVERED), F.col(PROMISED)
    return orders.withColumns(
        {
            "is_late": is_late(delivered, promised),
            "late_known": delivered > promised,
            "delivery_days": whole_days(bought, delivered),
            "promised_days": whole_days(bought, promised),
            "days_past_promise": whole_days(promised, delivered),
            "days_past_promise_floor": floor_days(promised, delivered),
        }
    )


def calendar_features(orders: DataFrame) -> DataFrame:
    ts = F.col(PURCHASED)
    return orders.withColumns(
        {
            "purchase_date": F.to_date(ts),
            "purchase_weekday": weekday_number(ts),
            "purchase_weekday_label": F.date_format(ts, "E"),
            "purchase_month": F.month(ts),
            "purchase_month_name": F.date_format(ts, "MMMM"),
        }
    )


def _described_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    return items.join(products, "product_id").join(sellers, "seller_id")


# Numbers of lines that fit the bits of one long.
_BITS = 64


def _counted_items(lines: DataFrame) -> tuple[Column, DataFrame | None]:
    """How many different item numbers an order has: an aggregate, and a frame of what it leaves out.

    A distinct count would shuffle every line twice, with all other sums of the
    roll-up.  Numbers from 0 to 63 are bits of one long instead, which is
    combined on the map side; lines with other numbers, if there are any, are
    counted apart.  Numbers that are no integers keep the distinct count.
    """
    number = F.col("order_item_id")
    if not isinstance(lines.schema["order_item_id"].dataType, T.IntegralType):
        return F.count_distinct(number), None
    is_bit = number.between(0, _BITS - 1)
    place = number.cast("bigint").bitwiseAND(_BITS - 1).cast("int")
    bits = F.bit_or(F.when(is_bit, F.call_function("shiftleft", F.lit(1).cast("bigint"), place)))
    others = lines.where(~is_bit).groupBy("order_id").agg(F.count_distinct(number).alias("__others"))
    return F.coalesce(F.bit_count(bits), F.lit(0)).cast("bigint"), others


def item_rollup(
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    category_rule: str = "first",
) -> DataFrame:
    """One row per order: counts, money, category and the range of seller states.

    ``category_rule`` is ``first`` (alphabetically) or ``mode`` (most item
    lines, then alphabetically).
    """
    lines = _described_items(items, products, sellers)
    n_items, others = _counted_items(lines)
    rolled = lines.groupBy("order_id").agg(
        n_items.alias("n_items"),
        money_sum(F.col("price")).alias("raw_price"),
        money_sum(F.col("freight_value")).alias("raw_freight"),
        F.avg(safe_ratio(F.col("freight_value"), F.col("price"))).alias("raw_ratio"),
        F.min("product_category_name").alias("first_category"),
        F.min("seller_state").alias("min_seller_state"),
        F.max("seller_state").alias("max_seller_state"),
    )
    if others is not None:
        whole = F.col("n_items") + F.coalesce(F.col("__others"), F.lit(0).cast("bigint"))
        rolled = rolled.join(others, "order_id", "left").withColumn("n_items", whole).drop("__others")
    if category_rule == "mode":
        counted = (
            lines.where(F.col("product_category_name").isNotNull())
            .groupBy("order_id", "product_category_name")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        common = counted.groupBy("order_id").agg(
            F.min(F.struct((-F.col("n")).alias("order"), F.col("product_category_name").alias("category"))).alias("m")
        )
        rolled = (
            rolled.drop("first_category")
            .join(common.select("order_id", F.col("m.category").alias("first_category")), "order_id", "left")
        )
    elif category_rule != "first":
        raise ValueError(f"category_rule must be 'first' or 'mode', not {category_rule!r}")
    return rolled


def _money_columns(rolled_price: Column, rolled_freight: Column) -> dict[str, Column]:
    return {
        "total_price": round_half_up(rolled_price, 2),
        "total_freight": round_half_up(rolled_freight, 2),
        "freight_to_price_ratio": round_half_up(F.col("raw_ratio"), 4),
    }


def _cross_state() -> Column:
    """1 if any seller state differs from the customer's.

    Some state differs exactly when the smallest or the largest one does.
    """
    home = F.col("customer_state")
    differs = (F.col("min_seller_state") != home) | (F.col("max_seller_state") != home)
    return F.coalesce(differs, F.lit(False)).cast("int")


_ROLLUP_INTERNALS = (
    "raw_price", "raw_freight", "raw_ratio", "first_category",
    "min_seller_state", "max_seller_state",
)


def order_features(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    category_rule: str = "first",
) -> DataFrame:
    """One row per delivered order with everything known about its items.

    Orders meet their customers while they are narrow; what follows is joined on
    the order alone, so the wide rows are not shuffled to the customers and back.
    """
    rolled = item_rollup(items, products, sellers, category_rule)
    places = customers.select("customer_id", "customer_state", "customer_city")
    joined = delivered_orders(orders).join(places, "customer_id").join(rolled, "order_id")
    promised = floor_days(F.col(PURCHASED), F.col(PROMISED))
    return joined.select(
        "order_id", "customer_id", PURCHASED, DELIVERED, PROMISED,
        (F.col(DELIVERED) > F.col(PROMISED)).cast("int").alias("target_late"),
        "customer_state", "customer_city", "n_items",
        *[c.alias(n) for n, c in _money_columns(F.col("raw_price"), F.col("raw_freight")).items()],
        promised.alias("promised_days"),
        weekday_number(F.col(PURCHASED)).alias("purchase_weekday"),
        F.month(PURCHASED).alias("purchase_month"),
        _cross_state().alias("cross_state"),
        F.coalesce(F.col("first_category"), F.lit("unknown")).alias("product_category"),
    )


def order_lists(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct sellers, categories and seller states of each order, sorted."""
    lines = _described_items(items, products, sellers)
    return lines.groupBy("order_id").agg(
        F.array_sort(F.collect_set("seller_id")).alias("seller_ids"),
        F.array_sort(F.collect_set("product_category_name")).alias("categories"),
        F.array_sort(F.collect_set("seller_state")).alias("seller_states"),
    ).withColumns(
        {
            "n_sellers": F.size("seller_ids"),
            "first_category": F.try_element_at("categories", F.lit(1)),
            "several_states": F.size("seller_states") > 1,
        }
    )


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Highest number of installments and first payment type of each order."""
    return payments.groupBy("order_id").agg(
        F.max("payment_installments").alias("payment_installments"),
        F.min("payment_type").alias("payment_type"),
    )


def payment_features(orders: DataFrame, payments: DataFrame, fill: bool = True) -> DataFrame:
    """Orders with their payment columns; an order without payment gets 1 and
    ``unknown`` unless ``fill`` is off."""
    joined = orders.join(payment_rollup(payments), "order_id", "left")
    return joined.na.fill({"payment_installments": 1, "payment_type": "unknown"}) if fill else joined


def review_rollup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("n_reviews"),
    )


def _mart(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    reviews: DataFrame,
    copies: Column,
) -> DataFrame:
    rolled = item_rollup(items, products, sellers)
    places = customers.select("customer_id", "customer_state", "customer_city")
    joined = (
        orders.join(rolled, "order_id")
        .join(review_rollup(reviews), "order_id", "left")
        .join(places, "customer_id")
    )
    derived = {
        "is_late": is_late(F.col(DELIVERED), F.col(PROMISED)),
        "delivery_days": whole_days(F.col(PURCHASED), F.col(DELIVERED)),
        "promised_days": whole_days(F.col(PURCHASED), F.col(PROMISED)),
        **_money_columns(F.col("raw_price") * copies, F.col("raw_freight") * copies),
        "cross_state": _cross_state(),
        "product_category": F.col("first_category"),
        "avg_review_score": F.coalesce(F.col("avg_review_score"), F.lit(0.0)),
    }
    return joined.withColumns(derived).drop(*_ROLLUP_INTERNALS, "n_reviews")


def lines_of(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of these orders, found before anything is rolled up."""
    return lines.join(orders.select("order_id"), "order_id", "left_semi")


def selected_mart(orders, items, products, sellers, customers, reviews) -> DataFrame:
    """``order_mart`` of a selection of orders: lines and reviews of other orders are left
    out at the scan's side of the roll-up, so its work falls with the selection."""
    return order_mart(orders, lines_of(orders, items), products, sellers, customers, lines_of(orders, reviews))


def order_mart(orders, items, products, sellers, customers, reviews) -> DataFrame:
    """One row per order with items, whatever its status; no review gives score 0."""
    return _mart(orders, items, products, sellers, customers, reviews, F.lit(1))


def order_mart_fanout(orders, items, products, sellers, customers, reviews) -> DataFrame:
    """The mart as a plain join of items and reviews gives it.

    There each item line appears once per review of its order, which multiplies
    the money sums by the number of reviews and leaves means, minima and
    distinct counts alone.  The lines themselves are never paired.
    """
    return _mart(
        orders, items, products, sellers, customers, reviews,
        F.greatest(F.coalesce(F.col("n_reviews"), F.lit(1)), F.lit(1)),
    )


def seller_order_outcomes(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Seller, order, time and lateness of each delivered item line."""
    delivered = delivered_orders(orders).select(
        "order_id", PURCHASED, (F.col(DELIVERED) > F.col(PROMISED)).cast("int").alias("is_late")
    )
    return items.select("order_id", "order_item_id", "seller_id").join(delivered, "order_id")
