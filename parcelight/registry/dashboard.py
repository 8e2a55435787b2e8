"""Registered queries behind the delivery dashboard."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.numbers import round_half_up
from parcelight.operators.orders import selected_mart
from parcelight.plans import dashboard as plan
from parcelight.registry.orders import MART_SQL, MART_VIEWS, mart
from parcelight.registry.spec import Spec, rounded
from parcelight.sources.fixtures import Inputs


def delivered(i: Inputs) -> DataFrame:
    return plan.delivered_only(mart(i))


_CHAIN = f", {MART_SQL}, delivered as (select * from mart where order_status = 'delivered')\n"


def _days_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


def _kpi_sql(source: str) -> str:
    money = "sum(total_price)"
    return f"""select count(*) as orders, {rounded(money, 2)} as total_revenue,
        {rounded("avg(delivery_days)", 4)} as avg_delivery_days,
        {rounded("avg(avg_review_score)", 4)} as avg_review,
        {rounded("avg(avg_review_score) filter (avg_review_score > 0)", 4)} as avg_review_reviewed,
        strftime(min(order_purchase_timestamp), '%Y-%m-%d') as first_day,
        strftime(max(order_purchase_timestamp), '%Y-%m-%d') as last_day from {source}"""


def _late_sql(column: str, least: int) -> str:
    return f"""select {column}, avg(is_late) as late_rate, count(*) as orders from delivered
        where {column} is not null group by 1 having count(*) >= {least}
        order by late_rate desc, {column} limit 15"""


def _selected(i: Inputs, orders: DataFrame) -> DataFrame:
    return selected_mart(orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_reviews)


def _preselected(i: Inputs) -> DataFrame:
    """The states come from the orders that have a line, without rolling the lines up."""
    placed = plan.delivered_only(i.shop_orders).join(i.shop_customers.select("customer_id", "customer_state"), "customer_id")
    states = plan.preselected_states(placed.join(i.shop_items.select("order_id"), "order_id", "left_semi"))
    chosen = plan.filter_orders(placed, states=states).select(*i.shop_orders.columns)
    return plan.kpi_overview(_selected(i, chosen))


def _in_range(i: Inputs) -> DataFrame:
    orders = plan.delivered_only(i.shop_orders)
    return plan.kpi_overview(_selected(i, plan.filter_orders(orders, first=date(1995, 1, 1), last=date(1997, 6, 30))))


def _empty(i: Inputs) -> DataFrame:
    """Whether a selection holds no order, for three selections."""
    orders = delivered(i)
    selections = {
        "all": orders,
        "unknown state": plan.filter_orders(orders, states=["nowhere"]),
        "before the first order": plan.filter_orders(orders, first=date(1900, 1, 1), last=date(1900, 1, 1)),
    }
    rows = [(name, int(plan.nothing_selected(chosen))) for name, chosen in selections.items()]
    return i.spark.createDataFrame(rows, "selection string, nothing int")


SPECS: dict[str, Spec] = {
    "empty_selection": Spec(
        _empty,
        MART_VIEWS,
        _CHAIN
        + """select 'all' as selection, cast(count(*) = 0 as int) as nothing from delivered
        union all select 'unknown state', cast(count(*) = 0 as int) from delivered where customer_state = 'nowhere'
        union all select 'before the first order', cast(count(*) = 0 as int) from delivered
            where order_purchase_timestamp < timestamp '1900-01-02'""",
    ),
    "kpi_overview": Spec(
        lambda i: _days_as_text(plan.kpi_overview(delivered(i))), MART_VIEWS, _CHAIN + _kpi_sql("delivered")
    ),
    "kpi_preselected_states": Spec(
        lambda i: _days_as_text(_preselected(i)),
        MART_VIEWS,
        _CHAIN
        + _kpi_sql(
            "delivered where customer_state in (select distinct customer_state from delivered order by 1 limit 5)"
        ),
    ),
    "kpi_date_range": Spec(
        lambda i: _days_as_text(_in_range(i)),
        MART_VIEWS,
        _CHAIN
        + _kpi_sql(
            "delivered where cast(order_purchase_timestamp as date) between date '1995-01-01' and date '1997-06-30'"
        ),
    ),
    "revenue_by_state": Spec(
        lambda i: plan.revenue_by_state(delivered(i)),
        MART_VIEWS,
        _CHAIN
        + f"""select customer_state,
            {rounded("sum(total_price)", 2)} as revenue,
            count(distinct order_id) as orders from delivered
        where customer_state is not null group by 1""",
    ),
    "late_rate_by_state": Spec(
        lambda i: plan.late_rate_by_state(delivered(i)), MART_VIEWS, _CHAIN + _late_sql("customer_state", 5)
    ),
    "late_rate_by_category": Spec(
        lambda i: plan.late_rate_by_category(delivered(i)),
        MART_VIEWS,
        _CHAIN + _late_sql("product_category", 10),
    ),
    "delivery_histogram": Spec(
        lambda i: plan.delivery_histogram(delivered(i)),
        MART_VIEWS,
        _CHAIN
        + """, ends as (select min(delivery_days) as lo, max(delivery_days) as hi from delivered),
        chosen as (select min(m * cast(power(10, k) as bigint)) as w from range(10) d(k), (values (1), (2), (5)) s(m), ends
            where floor(hi / (m * power(10, k))) - floor(lo / (m * power(10, k))) + 1 <= 30)
        select cast(floor(delivery_days / w) * w as int) as days_from, cast(w as int) as width, is_late, count(*) as orders
        from delivered, chosen where delivery_days is not null group by 1, 2, 3""",
    ),
    "category_list": Spec(
        lambda i: plan.category_list(delivered(i)),
        MART_VIEWS,
        _CHAIN
        + """select distinct product_category from delivered where product_category is not null
        order by 1""",
    ),
    "state_list": Spec(
        lambda i: plan.state_list(delivered(i)),
        MART_VIEWS,
        _CHAIN + "select distinct customer_state from delivered where customer_state is not null",
    ),
    "reviewed_scatter": Spec(
        lambda i: plan.reviewed_scatter(delivered(i)),
        MART_VIEWS,
        _CHAIN
        + """select order_id, delivery_days, avg_review_score, is_late from delivered
        where avg_review_score > 0
        order by md5(concat('42:', cast(order_id as varchar))), order_id limit 2000""",
    ),
    "late_review_impact": Spec(
        lambda i: plan.late_review_impact(delivered(i)),
        MART_VIEWS,
        _CHAIN
        + f"""select is_late, count(*) as orders, {rounded("avg(avg_review_score)", 4)} as avg_review
        from delivered where avg_review_score > 0 group by 1""",
    ),
}
