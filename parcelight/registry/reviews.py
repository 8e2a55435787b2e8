"""Registered queries over the apparel reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.text import AGE_BUCKETS, LAST_AGE_BUCKET
from parcelight.operators import quality
from parcelight.operators.sampling import seeded_sample
from parcelight.plans import reviews as plan
from parcelight.plans.dashboard import value_list
from parcelight.registry.spec import Spec, rounded, words_sql
from parcelight.session import shared_path
from parcelight.sources.fixtures import Inputs
from parcelight.sources.quoted_csv import scan_split_csv
from parcelight.sources.readers import NULL_TOKENS, scan_csv
from parcelight.sources.schemas import RAW_REVIEWS, REVIEW_HEADER, REVIEWS, ROW_NUMBER_HEADER
from parcelight.sources.sinks import write_csv

RAW = "apparel_reviews_raw"
RELOADED = "apparel_reviews_reloaded"
CONTENT = tuple(REVIEW_HEADER.values())
_CONTENT = ", ".join(CONTENT)

_COMPLETE = (
    "review_text is not null and division_name is not null"
    " and department_name is not null and class_name is not null"
)
_BUCKET = (
    "case "
    + " ".join(f"when age <= {upper} then '{name}'" for name, upper in AGE_BUCKETS)
    + f" else '{LAST_AGE_BUCKET}' end"
)


def clean_chain(source: str = RAW) -> str:
    """``reviews``: the cleaned table with derived columns, as SQL."""
    return f"""
, complete as (select * from {source} where {_COMPLETE}),
uniq as (select min(review_id) as review_id, {_CONTENT} from complete group by {_CONTENT}),
clean as (select review_id, clothing_id,
    case when (select bool_or(age <= 0 or age > 120) from uniq)
         then least(greatest(age, 18), 100) else age end as age,
    title, review_text, least(greatest(rating, 1), 5) as rating, recommended_ind,
    positive_feedback_count, division_name, department_name, class_name from uniq),
reviews as (select *, cast(len({words_sql("review_text")}) as int) as review_length,
    {_BUCKET} as age_bucket from clean)
"""


def table(inputs: Inputs) -> DataFrame:
    return plan.review_table(inputs.apparel_reviews_raw)


def raw_names() -> dict[str, str]:
    """The export's header of each column."""
    return {"review_id": ROW_NUMBER_HEADER, **{v: k for k, v in REVIEW_HEADER.items()}}


def _csv_scan(inputs: Inputs) -> DataFrame:
    """The raw reviews written under their export header and read back."""
    spark = inputs.spark
    path = shared_path(spark, "reviews-csv")
    write_csv(inputs.apparel_reviews_raw.withColumnsRenamed(raw_names()), path)
    back = scan_csv(spark, path, in_written_order(inputs))
    return quality.tidy_names(back.withColumnRenamed(ROW_NUMBER_HEADER, "review_id"))


def _split_csv_scan(inputs: Inputs) -> DataFrame:
    """The same file read in byte ranges."""
    spark = inputs.spark
    path = shared_path(spark, "reviews-csv")
    write_csv(inputs.apparel_reviews_raw.withColumnsRenamed(raw_names()), path)
    back = scan_split_csv(spark, path, in_written_order(inputs))
    return quality.tidy_names(back.withColumnRenamed(ROW_NUMBER_HEADER, "review_id"))


def in_written_order(inputs: Inputs):
    from pyspark.sql import types as T

    kinds = {f.name: f for f in RAW_REVIEWS.fields}
    return T.StructType([kinds[raw_names()[c]] for c in inputs.apparel_reviews_raw.columns])


def _null_token_sql(column: str) -> str:
    listed = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    return f"case when {column} not in ({listed}) then {column} end as {column}"


_TEXT_COLUMNS = ("title", "review_text", "division_name", "department_name", "class_name")
CSV_COLUMNS_SQL = (
    "select review_id, clothing_id, age, rating, recommended_ind, positive_feedback_count, "
    + ", ".join(_null_token_sql(c) for c in _TEXT_COLUMNS)
    + f" from {RAW}"
)

_COMMENTS = {f.name: f.metadata.get("comment", "") for f in REVIEWS.fields}
_SPARK_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}


_STORAGE_NAMES = {"BIGINT": "INTEGER", "INTEGER": "INTEGER", "VARCHAR": "VARCHAR", "DOUBLE": "FLOAT"}


def _typed(column: str, names: dict[str, str]) -> str:
    """The checking engine's own type of a column, under our names."""
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in names.items())
    return f"case any_value(typeof({column})) {arms} end"


def _column_rows(source: str, columns: tuple[str, ...], describe) -> str:
    return " union all ".join(
        f"select {i} as position, '{c}' as column_name, {describe(c, i)}, count(*) as n_rows from {source}"
        for i, c in enumerate(columns, 1)
    )


_PROFILED = ("review_id", *CONTENT)
_COUNTED = ("division_name", "department_name", "class_name", "rating")


def _duplicates(inputs: Inputs) -> DataFrame:
    """Whole rows with their id, rows without it, and texts alone."""
    reloaded = inputs.apparel_reviews_reloaded
    scopes = {"with_id": ("review_id", *CONTENT), "content": CONTENT, "text": ("review_text",)}
    parts = [
        quality.duplicate_profile(reloaded, columns).withColumn("scope", F.lit(scope))
        for scope, columns in scopes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _duplicate_sql(scope: str, columns: str) -> str:
    return f"""select '{scope}' as scope, n_rows, n_rows - n_distinct as duplicate_rows,
    (n_rows - n_distinct) * 100.0::double / n_rows as duplicate_pct from (
    select (select count(*) from {RELOADED}) as n_rows,
        (select count(*) from (select distinct {columns} from {RELOADED})) as n_distinct)"""


def _audit_step(number: int, name: str, before: str, after: str, ranges: bool = False) -> str:
    clipped = "rating < 1 or rating > 5", "age <= 0 or age > 120"
    counts = [f"(select count(*) from uniq where {c})" if ranges else "0" for c in clipped]
    return f"""select {number} as step, '{name}' as step_name,
    (select count(*) from {before}) as rows_before, (select count(*) from {after}) as rows_after,
    cast({counts[0]} as bigint) as ratings_clipped, cast({counts[1]} as bigint) as ages_out_of_range"""


def _lenient(inputs: Inputs) -> DataFrame:
    texts = inputs.events.selectExpr(
        "event_id",
        "case event_id % 10 when 3 then 'n/a' when 4 then '' else cast(cast(floor(value * 100) as bigint) as string) end as number_text",
        "case event_id % 10 when 5 then 'soon' when 6 then '2024-13-40' else cast(ts as string) end as ts_text",
    )
    return texts.select(
        "event_id",
        quality.lenient_number(F.col("number_text")).alias("number"),
        quality.lenient_timestamp(F.col("ts_text")).alias("moment"),
    )


SPECS: dict[str, Spec] = {
    "csv_scan": Spec(_csv_scan, RAW, CSV_COLUMNS_SQL),
    "split_csv_scan": Spec(_split_csv_scan, RAW, CSV_COLUMNS_SQL),
    "table_profile": Spec(
        lambda i: quality.table_profile(i.apparel_reviews_raw),
        RAW,
        _column_rows(
            RAW,
            _PROFILED,
            lambda c, i: f"{_typed(c, _SPARK_NAMES)} as data_type, {len(_PROFILED)} as n_columns",
        ),
    ),
    "schema_ddl": Spec(
        lambda i: quality.schema_ddl(table(i)),
        RAW,
        clean_chain()
        + _column_rows(
            "reviews",
            (*_PROFILED, "review_length", "age_bucket"),
            lambda c, i: f"{_typed(c, _STORAGE_NAMES)} as sql_type, '{_COMMENTS.get(c, '')}' as comment",
        ),
    ),
    "null_profile": Spec(
        lambda i: quality.null_profile(i.apparel_reviews_raw),
        RAW,
        " union all ".join(
            f"select '{c}' as column_name, count(*) - count({c}) as null_count,"
            f" (count(*) - count({c})) * 100.0::double / count(*) as null_pct from {RAW}"
            for c in _PROFILED
        ),
    ),
    "value_counts": Spec(
        lambda i: quality.value_counts(i.apparel_reviews_raw, _COUNTED),
        RAW,
        " union all ".join(
            f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as n"
            f" from {RAW} where {c} is not null group by {c}"
            for c in _COUNTED
        ),
    ),
    "duplicate_profile": Spec(
        _duplicates,
        RELOADED,
        " union all ".join(
            [
                _duplicate_sql("with_id", "review_id, " + _CONTENT),
                _duplicate_sql("content", _CONTENT),
                _duplicate_sql("text", "review_text"),
            ]
        ),
    ),
    "dedupe_reviews": Spec(
        lambda i: quality.drop_copies(i.apparel_reviews_reloaded),
        RELOADED,
        f"select min(review_id) as review_id, {_CONTENT} from {RELOADED} group by {_CONTENT}",
    ),
    "outlier_profile": Spec(
        lambda i: quality.outlier_profile(i.apparel_reviews_raw),
        RAW,
        f"""select 'rating' as column_name, rating as value, count(*) as n from {RAW}
            where rating < 1 or rating > 5 group by rating
            union all select 'age', age, count(*) from {RAW}
            where age <= 0 or age > 120 group by age""",
    ),
    "clean_audit": Spec(
        lambda i: quality.clean_audit(i.apparel_reviews_reloaded),
        RELOADED,
        f""", with_text as (select * from {RELOADED} where review_text is not null),
        complete as (select * from {RELOADED} where {_COMPLETE}),
        uniq as (select distinct {_CONTENT} from complete)
        select *, rows_before - rows_after as rows_dropped from ("""
        + " union all ".join(
            [
                _audit_step(1, "missing_text", RELOADED, "with_text"),
                _audit_step(2, "missing_category", "with_text", "complete"),
                _audit_step(3, "copies", "complete", "uniq"),
                _audit_step(4, "ranges", "uniq", "uniq", ranges=True),
            ]
        )
        + ")",
    ),
    "clean_reviews": Spec(
        lambda i: quality.clean_reviews(i.apparel_reviews_reloaded),
        RELOADED,
        clean_chain(RELOADED) + "select * from clean",
    ),
    "clip_ratings": Spec(
        lambda i: quality.clip_age(quality.clip_rating(i.apparel_reviews_raw)).select(
            "review_id", "rating", "age"
        ),
        RAW,
        f"""select review_id, least(greatest(rating, 1), 5) as rating,
            case when (select bool_or(age <= 0 or age > 120) from {RAW})
                 then least(greatest(age, 18), 100) else age end as age from {RAW}""",
    ),
    "seeded_sample": Spec(
        lambda i: seeded_sample(
            i.apparel_reviews_raw.where(F.col("review_text").isNotNull()).select(
                "review_id", "review_text", "rating"
            ),
            "review_id",
            300,
        ),
        RAW,
        f"""select review_id, review_text, rating from {RAW} where review_text is not null
            order by md5(concat('42:', cast(review_id as varchar))), review_id limit 300""",
    ),
    "lenient_cast": Spec(
        _lenient,
        "",
        """with t as (select event_id,
            case event_id % 10 when 3 then 'n/a' when 4 then ''
                else cast(cast(floor(value * 100) as bigint) as varchar) end as number_text,
            case event_id % 10 when 5 then 'soon' when 6 then '2024-13-40'
                else cast(ts as varchar) end as ts_text from events)
        select event_id, try_cast(number_text as double) as number,
            try_cast(ts_text as timestamp) as moment from t""",
    ),
    "department_list": Spec(
        lambda i: value_list(i.apparel_reviews_raw, "department_name"),
        RAW,
        f"select distinct department_name from {RAW} where department_name is not null order by 1",
    ),
    "review_length": Spec(
        lambda i: table(i).select("review_id", "review_length"),
        RAW,
        clean_chain() + "select review_id, review_length from reviews",
    ),
    "age_bucket": Spec(
        lambda i: table(i).select("review_id", "age", "age_bucket"),
        RAW,
        clean_chain() + "select review_id, age, age_bucket from reviews",
    ),
    "length_summary": Spec(
        lambda i: plan.length_summary(table(i)),
        RAW,
        clean_chain()
        + f"""select min(review_length) as min_length, max(review_length) as max_length,
            {rounded("avg(review_length)", 1)} as mean_length, min(rating) as min_rating,
            max(rating) as max_rating, min(age) as min_age, max(age) as max_age from reviews""",
    ),
    "age_bucket_counts": Spec(
        lambda i: plan.age_bucket_counts(table(i)),
        RAW,
        clean_chain() + "select age_bucket, count(*) as n from reviews group by 1 order by 1",
    ),
    "q1_department_rating": Spec(
        lambda i: plan.rating_by_department(table(i)),
        RAW,
        clean_chain()
        + f"""select department_name, {rounded("avg(rating)", 2)} as avg_rating,
            {rounded("avg(recommended_ind)*100", 1)} as recommend_rate_pct,
            count(*) as review_count from reviews group by 1 order by 2 desc, 1""",
    ),
    "q2_age_bucket_rating": Spec(
        lambda i: plan.rating_by_age_bucket(table(i)),
        RAW,
        clean_chain()
        + f"""select age_bucket, {rounded("avg(rating)", 2)} as avg_rating,
            count(*) as review_count from reviews group by 1""",
    ),
    "q3_length_by_recommend": Spec(
        lambda i: plan.length_by_recommendation(table(i)),
        RAW,
        clean_chain()
        + f"""select recommended_ind, {rounded("avg(review_length)", 1)} as avg_review_length,
            count(*) as review_count,
            case when recommended_ind = 1 then 'Yes' else 'No' end as recommended
            from reviews group by recommended_ind order by recommended_ind desc""",
    ),
    "q3b_length_stats": Spec(
        lambda i: plan.length_statistics(table(i)),
        RAW,
        clean_chain()
        + f"""select recommended_ind, min(review_length) as min_len,
            {rounded("avg(review_length)", 1)} as avg_len, max(review_length) as max_len,
            {rounded("stddev_samp(review_length)", 1)} as std_len, count(*) as cnt
            from reviews group by 1""",
    ),
    "q4a_lowest_recommend": Spec(
        lambda i: plan.lowest_recommended_classes(table(i)),
        RAW,
        clean_chain()
        + f"""select class_name, {rounded("avg(recommended_ind)*100", 1)} as recommend_rate_pct,
            {rounded("avg(rating)", 2)} as avg_rating, count(*) as review_count
            from reviews group by 1 order by 2, 1 limit 5""",
    ),
    "q4b_bottom_class_ratings": Spec(
        lambda i: plan.bottom_class_ratings(table(i)),
        RAW,
        clean_chain()
        + f""", bottom as (select class_name from reviews group by 1 having count(*) >= 20
            order by avg(recommended_ind), class_name limit 5)
        select r.class_name, r.rating, count(*) as cnt,
            {rounded("avg(r.recommended_ind)*100", 1)} as recommend_rate_pct
        from reviews r join bottom b on r.class_name = b.class_name group by 1, 2""",
    ),
}
