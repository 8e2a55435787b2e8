"""The numbers behind each panel of the delivery dashboard."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.dates import on_days
from parcelight.functions.numbers import money_sum, round_half_up
from parcelight.operators.orders import PURCHASED
from parcelight.operators.sampling import seeded_sample, top_rows


def delivered_only(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("order_status") == "delivered")


def filter_orders(
    mart: DataFrame,
    states: Sequence[str] | DataFrame | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Orders of some states and days; what is not given does not filter.

    ``states`` is a list or a small frame with a ``customer_state`` column.
    """
    chosen = mart.where(on_days(F.col(PURCHASED), first, last))
    if isinstance(states, DataFrame):
        return chosen.join(states, "customer_state", "left_semi")
    if states is not None:
        return chosen.where(F.col("customer_state").isin(list(states)))
    return chosen


def value_list(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column in order, for a choice of filters."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def nothing_selected(orders: DataFrame) -> bool:
    """Whether a selection is empty; reads no more than its first row."""
    return orders.isEmpty()


def state_list(mart: DataFrame) -> DataFrame:
    return value_list(mart, "customer_state")


def preselected_states(mart: DataFrame, n: int = 5) -> DataFrame:
    return state_list(mart).limit(n)


def category_list(mart: DataFrame) -> DataFrame:
    return value_list(mart, "product_category")


def kpi_overview(orders: DataFrame) -> DataFrame:
    """Totals of a selection; orders without a review count as score 0 in
    ``avg_review`` and are left out of ``avg_review_reviewed``."""
    score = F.col("avg_review_score")
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        round_half_up(money_sum(F.col("total_price")), 2).alias("total_revenue"),
        round_half_up(F.avg("delivery_days"), 4).alias("avg_delivery_days"),
        round_half_up(F.avg(score), 4).alias("avg_review"),
        round_half_up(F.avg(F.when(score > 0, score)), 4).alias("avg_review_reviewed"),
        F.to_date(F.min(PURCHASED)).alias("first_day"),
        F.to_date(F.max(PURCHASED)).alias("last_day"),
    )


def revenue_by_state(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(
            round_half_up(money_sum(F.col("total_price")), 2).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy(F.desc("revenue"), "customer_state")
    )


def late_rate_by(orders: DataFrame, column: str, min_orders: int, n: int = 15) -> DataFrame:
    """Groups with the highest late rate among those with enough orders."""
    rates = (
        orders.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.avg("is_late").alias("late_rate"), F.count("order_id").alias("orders"))
        .where(F.col("orders") >= min_orders)
    )
    return top_rows(rates, [F.desc("late_rate"), F.asc(column)], n)


def late_rate_by_state(orders: DataFrame) -> DataFrame:
    return late_rate_by(orders, "customer_state", min_orders=5)


def late_rate_by_category(orders: DataFrame) -> DataFrame:
    return late_rate_by(orders, "product_category", min_orders=10)


def bin_width(df: DataFrame, column: str, most: int = 30) -> DataFrame:
    """One row, one column: the smallest of 1, 2, 5, 10, 20, 50, ... that needs at most ``most`` bins.

    Bins start at multiples of their width.  Null if the column has no value.
    """
    widths = F.array(*[F.lit(m * 10**k).cast("bigint") for k in range(10) for m in (1, 2, 5)])
    bins = lambda w: F.floor(F.col("hi") / w) - F.floor(F.col("lo") / w) + 1
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return ends.select(F.try_element_at(F.filter(widths, lambda w: bins(w) <= most), F.lit(1)).alias("width"))


def delivery_histogram(orders: DataFrame, most: int = 30) -> DataFrame:
    """Orders per range of delivery days, late and on time apart, in at most ``most`` ranges."""
    known = orders.where(F.col("delivery_days").isNotNull())
    width = bin_width(known, "delivery_days", most).scalar()
    start = (F.floor(F.col("delivery_days") / width) * width).cast("int")
    return known.groupBy(start.alias("days_from"), width.cast("int").alias("width"), "is_late").agg(F.count(F.lit(1)).alias("orders"))


def reviewed_scatter(orders: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """A repeatable sample of reviewed orders."""
    reviewed = orders.where(F.col("avg_review_score") > 0).select(
        "order_id", "delivery_days", "avg_review_score", "is_late"
    )
    return seeded_sample(reviewed, "order_id", n, seed)


def late_review_impact(orders: DataFrame) -> DataFrame:
    """Mean review score of late and of punctual orders."""
    return (
        orders.where(F.col("avg_review_score") > 0)
        .groupBy("is_late")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            round_half_up(F.avg("avg_review_score"), 4).alias("avg_review"),
        )
    )
