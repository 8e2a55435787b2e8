"""Shop and review views over the test tables.

Each view is one SQL text that runs unchanged on Spark and on DuckDB; the names
in braces are tables or other views.  ``Inputs`` serves them as DataFrames and
``with_views`` as a chain of common table expressions for the SQL checks.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "shop_base": """
        select o_orderkey as order_id, o_custkey as customer_id,
            case when o_orderstatus <> 'P' then 'delivered'
                 when o_orderkey % 3 = 0 then 'shipped'
                 when o_orderkey % 3 = 1 then 'canceled' else 'unavailable' end as order_status,
            o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400) as ts,
            3 + ((o_orderkey * 7919) % 9973) % 28 as d_days,
            5 + ((o_orderkey * 104729) % 9967) % 21 as e_days
        from {orders}""",
    "shop_orders": """
        select order_id, customer_id, order_status, ts as order_purchase_timestamp,
            case when order_status = 'delivered'
                 then ts + INTERVAL '1' DAY * d_days end as order_delivered_customer_date,
            case when order_status in ('delivered', 'shipped')
                 then ts + INTERVAL '1' DAY * e_days + INTERVAL '1' HOUR * (order_id % 24)
                 end as order_estimated_delivery_date
        from {shop_base}""",
    "shop_items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
            l_suppkey as seller_id, l_extendedprice as price,
            l_quantity * (1 + l_tax) as freight_value
        from {lineitem}""",
    "shop_products": """
        select p_partkey as product_id, p_brand as product_category_name from {part}""",
    "shop_sellers": """
        select s_suppkey as seller_id, n_name as seller_state
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "shop_customers": """
        select c_custkey as customer_id, n_name as customer_state, c_mktsegment as customer_city
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "shop_payments": """
        select l_orderkey as order_id, l_linenumber as payment_sequential,
            case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto'
                 else 'voucher' end as payment_type,
            cast(l_quantity as int) % 12 + 1 as payment_installments
        from {lineitem} where l_linenumber <= 2""",
    "shop_reviews": """
        select event_id as review_id,
            event_id - case when event_id % 10 = 9 then 1 else 0 end as order_id,
            1 + cast(floor(value) as int) % 5 as review_score
        from {events}""",
    "apparel_reviews_raw": """
        select d.doc_id as review_id, d.doc_id % 97 as clothing_id,
            cast(case when d.doc_id % 199 = 7 then 130
                 else 16 + (d.doc_id * 7919) % 9973 % 55 end as int) as age,
            case when d.doc_id % 7 <> 0 then d.source end as title,
            case when d.doc_id % 29 <> 0 then d.text end as review_text,
            cast(1 + (d.doc_id * 104729) % 9967 % 5 as int) as rating,
            cast(coalesce(l.quality,
                 case when (d.doc_id * 104729) % 9967 % 5 >= 3 then 1 else 0 end)
                 as int) as recommended_ind,
            cast(d.n_chars % 40 as int) as positive_feedback_count,
            upper(d.lang) as division_name,
            case when d.doc_id % 101 <> 5
                 then concat('dept', cast(d.doc_id * 31 % 6 as varchar(9))) end as department_name,
            d.source as class_name
        from {documents} d left join {labels} l on d.doc_id = l.doc_id""",
    # The same export loaded twice: every row has one exact copy under another id.
    "apparel_reviews_reloaded": """
        select * from {apparel_reviews_raw}
        union all
        select review_id + 1000000000000 as review_id, clothing_id, age, title, review_text,
            rating, recommended_ind, positive_feedback_count, division_name,
            department_name, class_name
        from {apparel_reviews_raw}""",
    "llm_responses": """
        select doc_id as review_id,
            case doc_id % 8
                when 0 then 'not json'
                when 1 then '{{"sentiment":"neutral"}}'
                when 2 then concat(repeat(chr(96), 3), 'json', chr(10),
                    '{{"sentiment":"negative","complaint_category":"sizing","would_recommend_reason":"too small"}}',
                    chr(10), repeat(chr(96), 3))
                when 3 then '{{"sentiment":"negative","complaint_category":"fabric","would_recommend_reason":"thin"}}'
                when 4 then '{{"sentiment":"negative","complaint_category":"quality","would_recommend_reason":"seams"}}'
                when 5 then '{{"sentiment":"neutral","complaint_category":"color_mismatch","would_recommend_reason":"shade"}}'
                when 6 then '{{"sentiment":"negative","complaint_category":"other","would_recommend_reason":"late"}}'
                else '{{"sentiment":"positive","complaint_category":"none","would_recommend_reason":"fits"}}'
            end as raw
        from {documents}""",
    # Labels and scores made from keys, with many tied scores.
    "score_table": """
        select o_orderkey as order_id, cast(o_orderkey % 2 as int) as label,
            cast((o_orderkey * 7919) % 101 as double) / 126.25e0
                + cast(o_orderkey % 2 as double) * 0.2e0 as score
        from {orders}""",
}


def _needs(name: str) -> list[str]:
    found = [field for _, field, _, _ in string.Formatter().parse(VIEWS[name]) if field]
    return list(dict.fromkeys(found))


class Inputs:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            return self.spark.sql(VIEWS[name], **{n: getattr(self, n) for n in _needs(name)})
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def view_chain(*names: str) -> str:
    """The named views and all they need, as the body of a WITH clause."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in ordered or name not in VIEWS:
            return
        needs = _needs(name)
        for need in needs:
            visit(need)
        ordered[name] = VIEWS[name].format(**{n: n for n in needs})

    for name in names:
        visit(name)
    return ",\n".join(f"{name} as ({text})" for name, text in ordered.items())


def with_views(names: str, body: str) -> str:
    """``body`` with the space-separated views in scope.

    A body that brings its own common table expressions starts with a comma.
    """
    return f"with {view_chain(*names.split())}\n{body}"
