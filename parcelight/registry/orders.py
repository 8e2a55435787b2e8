"""Registered queries over the order star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.numbers import round_half_up
from parcelight.operators import history, orders
from parcelight.operators.orders import DELIVERED, PROMISED, PURCHASED
from parcelight.plans import modeling
from parcelight.registry.spec import Spec, rounded
from parcelight.session import shared_path
from parcelight.sources.fixtures import Inputs
from parcelight.streaming.seller_history import SellerHistory

STAR = "shop_orders shop_items shop_products shop_sellers shop_customers"

DELIVERED_SQL = (
    "order_status = 'delivered' and order_delivered_customer_date is not null"
    " and order_estimated_delivery_date is not null"
)
_D, _E, _P = (
    "o.order_delivered_customer_date",
    "o.order_estimated_delivery_date",
    "o.order_purchase_timestamp",
)


def floor_days_sql(start: str, end: str) -> str:
    return f"cast(floor((epoch({end}) - epoch({start})) / 86400) as int)"


def trunc_days_sql(start: str, end: str) -> str:
    return f"cast(trunc((epoch({end}) - epoch({start})) / 86400) as int)"


def money_sql(column: str) -> str:
    return rounded(f"sum({column})", 2)


ITEM_COLUMNS_SQL = f"""count(distinct i.order_item_id) as n_items,
    {money_sql("i.price")} as total_price, {money_sql("i.freight_value")} as total_freight,
    {rounded("avg(i.freight_value / nullif(i.price, 0))", 4)} as freight_to_price_ratio,
    max(case when c.customer_state <> s.seller_state then 1 else 0 end) as cross_state"""

STAR_JOIN_SQL = """from shop_orders o join shop_customers c on o.customer_id = c.customer_id
    join shop_items i on o.order_id = i.order_id
    join shop_products p on i.product_id = p.product_id
    join shop_sellers s on i.seller_id = s.seller_id"""

FEATURES_SQL = f"""features as (
    select o.order_id, any_value(o.customer_id) as customer_id,
        any_value({_P}) as order_purchase_timestamp,
        any_value({_D}) as order_delivered_customer_date,
        any_value({_E}) as order_estimated_delivery_date,
        any_value(cast({_D} > {_E} as int)) as target_late,
        any_value(c.customer_state) as customer_state, any_value(c.customer_city) as customer_city,
        {ITEM_COLUMNS_SQL},
        any_value({floor_days_sql(_P, _E)}) as promised_days,
        any_value(cast(isodow({_P}) - 1 as int)) as purchase_weekday,
        any_value(cast(month({_P}) as int)) as purchase_month,
        coalesce(min(p.product_category_name), 'unknown') as product_category
    {STAR_JOIN_SQL} where o.{DELIVERED_SQL} group by o.order_id)"""

PAID_SQL = """paid as (select order_id, max(payment_installments) as payment_installments,
    min(payment_type) as payment_type from shop_payments group by order_id)"""

HISTORY_SQL = f"""pairs as (select distinct o.order_id, i.seller_id,
        {_P} as ts, cast({_D} > {_E} as bigint) as late
    from shop_orders o join shop_items i on o.order_id = i.order_id where o.{DELIVERED_SQL}),
by_seller as (select *, count(*) over w as seller_orders, coalesce(sum(late) over w, 0) as seller_late
    from pairs window w as (partition by seller_id order by ts, order_id
        rows between unbounded preceding and 1 preceding)),
per_order as (select order_id, ts, count(*) as n, sum(late) as l from pairs group by 1, 2),
everyone as (select order_id, cast(coalesce(sum(n) over w, 0) as bigint) as all_pairs,
        cast(coalesce(sum(l) over w, 0) as bigint) as all_late
    from per_order window w as (order by ts, order_id
        rows between unbounded preceding and 1 preceding)),
history as (select order_id, avg(case when seller_orders >= 3 then seller_late::double / seller_orders
        when all_pairs >= 3 then all_late::double / all_pairs else 0 end) as rate
    from by_seller join everyone using (order_id) group by order_id)"""

DATASET_SQL = f"""{FEATURES_SQL}, {PAID_SQL}, {HISTORY_SQL},
dataset as (select f.*, coalesce(paid.payment_installments, 1) as payment_installments,
        coalesce(paid.payment_type, 'unknown') as payment_type,
        coalesce(history.rate, 0) as seller_hist_late_rate
    from features f left join paid using (order_id) left join history using (order_id))"""


def features(i: Inputs) -> DataFrame:
    return orders.order_features(
        i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers
    )


def mart(i: Inputs) -> DataFrame:
    return orders.order_mart(
        i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_reviews
    )


def dataset(i: Inputs) -> DataFrame:
    return modeling.model_dataset(
        i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_payments
    )


def _as_text(name: str):
    return F.array_join(F.transform(name, lambda x: x.cast("string")), ",").alias(name)


def _order_lists(i: Inputs) -> DataFrame:
    lists = orders.order_lists(i.shop_items, i.shop_products, i.shop_sellers)
    return lists.withColumns(
        {c: _as_text(c) for c in ("seller_ids", "categories", "seller_states")}
        | {"several_states": F.col("several_states").cast("int")}
    )


def _delivery_days(i: Inputs) -> DataFrame:
    return orders.delivery_days(i.shop_orders).select(
        "order_id", "is_late", F.col("late_known").cast("int").alias("late_known"),
        "delivery_days", "promised_days", "days_past_promise", "days_past_promise_floor",
    )


def _calendar(i: Inputs) -> DataFrame:
    return orders.calendar_features(i.shop_orders).select(
        "order_id", F.col("purchase_date").cast("string").alias("purchase_date"), "purchase_weekday",
        "purchase_weekday_label", "purchase_month", "purchase_month_name",
    )


def _mart_sql(reviews: str, score: str) -> str:
    return f"""select o.order_id, any_value(o.customer_id) as customer_id,
        any_value(c.customer_state) as customer_state, any_value(c.customer_city) as customer_city,
        any_value(o.order_status) as order_status, any_value({_P}) as order_purchase_timestamp,
        any_value({_D}) as order_delivered_customer_date,
        any_value({_E}) as order_estimated_delivery_date,
        max(case when {_D} > {_E} then 1 else 0 end) as is_late,
        any_value({trunc_days_sql(_P, _D)}) as delivery_days,
        any_value({trunc_days_sql(_P, _E)}) as promised_days,
        {ITEM_COLUMNS_SQL}, min(p.product_category_name) as product_category,
        coalesce({score}, 0) as avg_review_score
    {STAR_JOIN_SQL} {reviews} group by o.order_id"""


MART_SQL = "reviewed as (select order_id, avg(review_score) as score from shop_reviews group by 1), " + (
    "mart as ("
    + _mart_sql("left join reviewed v on o.order_id = v.order_id", "any_value(v.score)")
    + ")"
)
MART_VIEWS = STAR + " shop_reviews"

_FANOUT_SQL = _mart_sql(
    "left join shop_reviews v on o.order_id = v.order_id", "avg(v.review_score)"
)

_MODEL_COLUMNS = ", ".join((*modeling.MODEL_COLUMNS[:-1], "order_purchase_timestamp"))
_LIGHT_COLUMNS = ", ".join(
    c for c in modeling.LIGHT_COLUMNS
    if c not in ("target_late", "purchase_weekday", "purchase_month", "seller_hist_late_rate")
)

_TIME = [PURCHASED, "order_id"]


def split_frame(i: Inputs) -> DataFrame:
    """Delivered orders in time order, cut into train and test."""
    timed = orders.delivered_orders(i.shop_orders).select(
        "order_id", PURCHASED, (F.col(DELIVERED) > F.col(PROMISED)).cast("int").alias("target_late")
    )
    return history.time_split(timed, _TIME)


def _arriving(i: Inputs) -> DataFrame:
    """Seller history after three arrivals, the last of them orders from among the others."""
    arrivals = SellerHistory(i.spark, shared_path(i.spark, "seller-history"), unit="month")
    late = F.col("order_id") % 7 == 0
    early = F.col(PURCHASED) < "1998-01-01"
    for number, chosen in enumerate((~late & early, ~late & ~early, late)):
        orders_now = i.shop_orders.where(chosen)
        arrivals.add(number, orders_now, orders.lines_of(orders_now, i.shop_items))
    rate = round_half_up(F.col("seller_hist_late_rate"), 6).alias("seller_hist_late_rate")
    return arrivals.rates().select("order_id", rate)


_SPLIT_SQL = f""", timed as (select order_id, order_purchase_timestamp,
        cast(order_delivered_customer_date > order_estimated_delivery_date as int) as target_late
    from shop_orders where {DELIVERED_SQL}),
placed as (select *, row_number() over (order by order_purchase_timestamp, order_id) - 1 as position
    from timed),
split as (select *, case when position < floor(0.8::double * (select count(*) from timed))
    then 'train' else 'test' end as part from placed)
"""

SPECS: dict[str, Spec] = {
    "delivered_orders": Spec(
        lambda i: orders.delivered_orders(i.shop_orders),
        "shop_orders",
        f"select * from shop_orders where {DELIVERED_SQL}",
    ),
    "order_features": Spec(features, STAR, f", {FEATURES_SQL} select * from features"),
    "order_lists": Spec(
        _order_lists,
        STAR,
        """, l as (select i.order_id, list_sort(list(distinct i.seller_id)) as s,
            list_sort(list(distinct p.product_category_name)) as c,
            list_sort(list(distinct s.seller_state)) as t
        from shop_items i join shop_products p on i.product_id = p.product_id
        join shop_sellers s on i.seller_id = s.seller_id group by i.order_id)
        select order_id, array_to_string(s, ',') as seller_ids, array_to_string(c, ',') as categories,
            array_to_string(t, ',') as seller_states, cast(len(s) as int) as n_sellers,
            c[1] as first_category, cast(len(t) > 1 as int) as several_states from l""",
    ),
    "payment_features": Spec(
        lambda i: orders.payment_features(i.shop_orders.select("order_id"), i.shop_payments),
        "shop_orders shop_payments",
        f""", {PAID_SQL} select o.order_id, coalesce(payment_installments, 1) as payment_installments,
            coalesce(payment_type, 'unknown') as payment_type
        from shop_orders o left join paid on o.order_id = paid.order_id""",
    ),
    "seller_order_outcomes": Spec(
        lambda i: orders.seller_order_outcomes(i.shop_orders, i.shop_items),
        STAR,
        f"""select i.order_id, i.order_item_id, i.seller_id, {_P} as order_purchase_timestamp,
            cast({_D} > {_E} as int) as is_late
        from shop_orders o join shop_items i on o.order_id = i.order_id where o.{DELIVERED_SQL}""",
    ),
    "order_mart": Spec(mart, MART_VIEWS, f", {MART_SQL} select * from mart"),
    "order_mart_fanout": Spec(
        lambda i: orders.order_mart_fanout(
            i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_reviews
        ),
        MART_VIEWS,
        _FANOUT_SQL,
    ),
    "delivery_days": Spec(
        _delivery_days,
        "shop_orders",
        f"""select o.order_id, case when {_D} > {_E} then 1 else 0 end as is_late,
            cast({_D} > {_E} as int) as late_known, {trunc_days_sql(_P, _D)} as delivery_days,
            {trunc_days_sql(_P, _E)} as promised_days, {trunc_days_sql(_E, _D)} as days_past_promise,
            {floor_days_sql(_E, _D)} as days_past_promise_floor from shop_orders o""",
    ),
    "calendar_features": Spec(
        _calendar,
        "shop_orders",
        f"""select o.order_id, strftime({_P}, '%Y-%m-%d') as purchase_date,
            cast(isodow({_P}) - 1 as int) as purchase_weekday,
            strftime({_P}, '%a') as purchase_weekday_label, cast(month({_P}) as int) as purchase_month,
            strftime({_P}, '%B') as purchase_month_name from shop_orders o""",
    ),
    "seller_hist_late_rate": Spec(
        lambda i: history.seller_hist_late_rate(i.shop_orders, i.shop_items).select(
            "order_id", round_half_up(F.col("seller_hist_late_rate"), 6).alias("seller_hist_late_rate")
        ),
        STAR,
        f", {HISTORY_SQL} select order_id, {rounded('rate', 6)} as seller_hist_late_rate from history",
    ),
    "arriving_seller_history": Spec(
        _arriving, STAR, f", {HISTORY_SQL} select order_id, {rounded('rate', 6)} as seller_hist_late_rate from history"
    ),
    "global_running_late_rate": Spec(
        lambda i: history.global_running_late_rate(i.shop_orders, i.shop_items),
        STAR,
        f""", {HISTORY_SQL} select order_id, all_pairs, all_late,
            case when all_pairs >= 3 then all_late::double / all_pairs else 0 end as global_late_rate
        from everyone""",
    ),
    "model_dataset": Spec(
        lambda i: dataset(i).withColumn(
            "seller_hist_late_rate", round_half_up(F.col("seller_hist_late_rate"), 6)
        ),
        STAR + " shop_payments",
        f", {DATASET_SQL} select {_MODEL_COLUMNS}, {rounded('seller_hist_late_rate', 6)} as seller_hist_late_rate from dataset",
    ),
    "light_model_dataset": Spec(
        lambda i: modeling.light_model_dataset(mart(i)),
        MART_VIEWS,
        f""", {MART_SQL} select {_LIGHT_COLUMNS}, order_purchase_timestamp, is_late as target_late,
            cast(isodow(order_purchase_timestamp) - 1 as int) as purchase_weekday,
            cast(month(order_purchase_timestamp) as int) as purchase_month,
            (select avg(is_late) from mart) as seller_hist_late_rate
        from mart where {DELIVERED_SQL}""",
    ),
    "global_rate_feature": Spec(
        lambda i: modeling.with_global_rate(
            mart(i).select("order_id", "is_late"), mart(i), "global_late_rate"
        ),
        MART_VIEWS,
        f", {MART_SQL} select order_id, is_late, (select avg(is_late) from mart) as global_late_rate from mart",
    ),
    "time_split": Spec(
        split_frame, "shop_orders", _SPLIT_SQL + "select * from split"
    ),
    "target_balance": Spec(
        lambda i: history.target_balance(split_frame(i)),
        "shop_orders",
        _SPLIT_SQL
        + """, counted as (select part, count(*) as n, sum(target_late) as n_late from split group by 1
            union all select 'all', count(*), sum(target_late) from split)
        select part, n, cast(n_late as bigint) as n_late, cast(n - n_late as bigint) as n_on_time,
            n_late * 100.0::double / n as late_pct from counted""",
    ),
}
