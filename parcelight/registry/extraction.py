"""Registered queries for prompts, answers and complaint findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.plans import extraction as plan
from parcelight.registry.reviews import _BUCKET, RAW
from parcelight.registry.spec import Spec
from parcelight.sources.fixtures import Inputs

_SYSTEM = plan.instructions().replace("'", "''")


def _parse_sql(source: str, raw: str, name: str) -> str:
    """Unwrap a fence, then read the object if it is one and has all keys."""
    present = " and ".join(f"list_contains(json_keys(body), '{k}')" for k in plan.KEYS)
    fields = ", ".join(f"case when ok then json_extract_string(body, '$.{k}') end as {k}" for k in plan.KEYS)
    return f"""{name}_body as (select *, trim(case when starts_with(trim({raw}, ' ' || chr(10)), '```')
        then regexp_replace(regexp_replace(trim({raw}, ' ' || chr(10)), '^```[^\\n]*\\n', ''), '\\n```$', '')
        else {raw} end, ' ' || chr(10)) as body from {source}),
{name}_ok as (select *, case when not json_valid(body) then false
    when json_type(body) <> 'OBJECT' then false else {present} end as ok from {name}_body),
{name} as (select * exclude (body), {fields} from {name}_ok)"""


def _fallback_sql(prefix: str = "") -> str:
    return ", ".join(
        f"case when ok then {k} else '{v}' end as {k}" for k, v in zip(plan.KEYS, plan.FALLBACK)
    )


EXTRACTED_SQL = f", {_parse_sql('llm_responses', 'raw', 'p')}, extracted as (select review_id, ok, {_fallback_sql()} from p)\n"
_JOINED = EXTRACTED_SQL + f""", joined as (select r.*, sentiment, complaint_category, would_recommend_reason
    from {RAW} r join extracted e on r.review_id = e.review_id)
"""
_VIEWS = RAW + " llm_responses"


def extracted(i: Inputs) -> DataFrame:
    return plan.parse_extractions(i.llm_responses)


def joined(i: Inputs) -> DataFrame:
    return plan.extraction_join(i.apparel_reviews_raw, extracted(i))


def _ok_as_int(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


_RETRY_ANSWER = '{"sentiment":"neutral","complaint_category":"none","would_recommend_reason":"second try"}'


def _two_attempts(i: Inputs) -> DataFrame:
    """First answers, and second ones that are readable for even ids."""
    return i.llm_responses.withColumn(
        "raw_retry", F.when(F.col("review_id") % 16 == 0, "still not json").otherwise(_RETRY_ANSWER)
    )


_SAID = (
    "not json",
    '{"sentiment":"neutral"}',
    '```json\n{"sentiment":"negative","complaint_category":"sizing","would_recommend_reason":"too small"}\n```',
    '{"sentiment":"negative","complaint_category":"fabric","would_recommend_reason":"thin"}',
    '{"sentiment":"positive","complaint_category":"none","would_recommend_reason":"fits"}',
)


def _extract(i: Inputs) -> DataFrame:
    """Both rounds of asking, with a stand-in service that goes by the length of the prompt."""
    said = list(_SAID)

    def answer(prompts):
        return [said[len(text) % len(said)] for text in prompts["user_text"]]

    return _ok_as_int(plan.extract(i.apparel_reviews_raw, answer), "parsed_ok")


_SAID_SQL = "case length(user_text) % {n} {arms} end".format(
    n=len(_SAID), arms=" ".join("when {} then '{}'".format(k, text.replace("\n", "' || chr(10) || '")) for k, text in enumerate(_SAID))
)


def _matrix_sql(by: str, source: str = "joined") -> str:
    counts = ", ".join(f"count(*) filter (complaint_category = '{c}') as {c}" for c in plan.COMPLAINTS)
    listed = ", ".join(f"'{c}'" for c in plan.COMPLAINTS)
    return f"""select {by}, {counts}, count(*) filter (complaint_category not in ({listed})) as unlisted
        from {source} where {by} is not null and complaint_category is not null group by {by}"""


_TOP_SQL = _JOINED + """, counts as (select department_name, complaint_category, count(*) as n from joined
    where department_name is not null group by 1, 2),
top as (select department_name, complaint_category as top_complaint, n as top_count from counts
    qualify row_number() over (partition by department_name order by n desc, complaint_category) = 1)
"""
_ADVICE_SQL = "case top_complaint " + " ".join(f"when '{k}' then '{v}'" for k, v in plan.ADVICE.items()) + " end"

_NOTICE_SQL = "case top_complaint " + " ".join(f"when '{k}' then '{v} - '" for k, v in plan.NOTICE.items()) + " else '' end"

SPECS: dict[str, Spec] = {
    "prompt_build": Spec(
        lambda i: plan.prompt_build(i.apparel_reviews_raw).select("review_id", "system_text", "user_text"),
        RAW,
        f"""select review_id, '{_SYSTEM}' as system_text,
            concat('Review: "', review_text, '"') as user_text from {RAW} where review_text is not null""",
    ),
    "parse_extractions": Spec(
        lambda i: _ok_as_int(extracted(i), "parsed_ok"),
        "llm_responses",
        EXTRACTED_SQL + f"select review_id, cast(ok as int) as parsed_ok, {', '.join(plan.KEYS)} from extracted",
    ),
    "extract_retry": Spec(
        lambda i: _ok_as_int(plan.parse_attempts(_two_attempts(i)), "parsed_ok"),
        "llm_responses",
        f""", two as (select *, case when review_id % 16 = 0 then 'still not json'
            else '{_RETRY_ANSWER}' end as raw_retry from llm_responses),
        {_parse_sql("two", "raw", "p1")}, first as (select review_id, raw_retry, ok as ok1,
            {", ".join(f"{k} as {k}1" for k in plan.KEYS)} from p1),
        {_parse_sql("first", "raw_retry", "p2")}
        select review_id, cast(ok1 or ok as int) as parsed_ok,
            case when ok1 then 1 when ok then 2 else 0 end as attempt, """
        + ", ".join(
            f"case when ok1 then {k}1 when ok then {k} else '{v}' end as {k}"
            for k, v in zip(plan.KEYS, plan.FALLBACK)
        )
        + " from p2",
    ),
    "extract_reviews": Spec(
        _extract,
        RAW,
        f""", prompts as (select review_id, concat('Review: "', review_text, '"') as user_text
            from {RAW} where review_text is not null),
        said as (select review_id, {_SAID_SQL} as raw from prompts),
        {_parse_sql("said", "raw", "p")}
        select review_id, cast(ok as int) as parsed_ok, {_fallback_sql()} from p""",
    ),
    "extraction_quality": Spec(
        lambda i: _ok_as_int(plan.extraction_quality(extracted(i)), "parsed_ok", "sentiment_ok", "category_ok"),
        "llm_responses",
        EXTRACTED_SQL
        + f"""select sentiment, complaint_category, cast(ok as int) as parsed_ok, count(*) as n,
            cast(sentiment in {plan.SENTIMENTS} as int) as sentiment_ok,
            cast(complaint_category in {plan.COMPLAINTS} as int) as category_ok
        from extracted group by 1, 2, 3, 5, 6""",
    ),
    "extraction_join": Spec(joined, _VIEWS, _JOINED + "select * from joined"),
    "complaints_by_department": Spec(
        lambda i: plan.complaint_matrix(joined(i), "department_name"),
        _VIEWS,
        _JOINED + _matrix_sql("department_name"),
    ),
    "complaints_by_class": Spec(
        lambda i: plan.complaint_matrix(joined(i), "class_name"), _VIEWS, _JOINED + _matrix_sql("class_name")
    ),
    "complaints_by_age_bucket": Spec(
        lambda i: plan.complaints_by_age_bucket(joined(i)),
        _VIEWS,
        _JOINED
        + f", aged as (select *, {_BUCKET} as age_bucket from joined)\n"
        + _matrix_sql("age_bucket", "aged"),
    ),
    "top_complaint": Spec(
        lambda i: plan.top_complaint(joined(i)), _VIEWS, _TOP_SQL + "select * from top"
    ),
    "recommendations": Spec(
        lambda i: plan.recommendations(joined(i)),
        _VIEWS,
        _TOP_SQL
        + f"""select *, {_ADVICE_SQL} as advice,
            concat(department_name, ': ', {_NOTICE_SQL}, top_count, ' ', top_complaint, ' complaints') as notice
        from top where top_complaint <> 'none' and top_count > 0""",
    ),
    "review_explorer": Spec(
        lambda i: plan.review_explorer(joined(i), sentiment="negative"),
        _VIEWS,
        _JOINED
        + """, chosen as (select * from joined where sentiment = 'negative')
        select review_id, rating, department_name, age, sentiment, complaint_category, review_text,
            (select count(*) from chosen) as matches from chosen order by review_id limit 50""",
    ),
}
