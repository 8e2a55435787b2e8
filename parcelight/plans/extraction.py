"""Structured facts from review texts: prompt, completion, parsing, findings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions.text import age_bucket, strip_code_fence
from parcelight.session import cut_lineage

# Keys of an answer, allowed labels, and the record that stands
# in for an answer that could not be read.
KEYS = ("sentiment", "complaint_category", "would_recommend_reason")
SENTIMENTS = ("positive", "negative", "neutral")
COMPLAINTS = ("sizing", "quality", "fabric", "color_mismatch", "none", "other")
FALLBACK = ("neutral", "none", "parse-failed")

# What to do about the most frequent complaint of a department,
# as a sentence and as the label of a count.
ADVICE = {
    "sizing": "Review and update the size chart for this department",
    "quality": "Investigate supplier quality standards",
    "fabric": "Consider alternative fabric sourcing options",
    "color_mismatch": "Review product photography/color representation",
}

NOTICE = {
    "sizing": "Review size chart",
    "quality": "Investigate supplier quality",
    "fabric": "Consider fabric sourcing",
}

_ANSWER = "array<struct<" + ",".join(f"{k}:string" for k in KEYS) + ">>"
_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


# ---- prompt ------------------------------------------------------------------


def instructions() -> str:
    """What the completion service is asked to return."""
    listed = {"sentiment": SENTIMENTS, "complaint_category": COMPLAINTS}
    lines = [
        f"- {k}: " + ("one of " + ", ".join(listed[k]) if k in listed else "a few words on why the reviewer would or would not recommend the item")
        for k in KEYS
    ]
    example = '{"sentiment": "negative", "complaint_category": "sizing", "would_recommend_reason": "runs two sizes small"}'
    return (
        "Read one product review and reply with a single JSON object, without fences or any other text. "
        "It has these keys:\n" + "\n".join(lines)
        + '\n\nFor the review "Nice color, but it runs two sizes small." the reply is\n' + example
    )


def prompt_build(reviews: DataFrame, text: str = "review_text") -> DataFrame:
    """System and user text of each review that has a text."""
    return reviews.where(F.col(text).isNotNull()).withColumns(
        {
            "system_text": F.lit(instructions()),
            "user_text": F.concat(F.lit('Review: "'), F.col(text), F.lit('"')),
        }
    )


# ---- completion --------------------------------------------------------------

Complete = Callable[[pd.DataFrame], pd.Series]


def complete(prompts: DataFrame, answer: Complete, key: str = "review_id") -> DataFrame:
    """Key and raw answer of each prompt; ``answer`` gets whole Arrow batches of
    system_text and user_text and is free to call any service."""
    asked = prompts.select(key, "system_text", "user_text")
    kind = asked.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "raw": list(answer(batch))})

    return asked.mapInPandas(run, f"{key} {kind}, raw string")


# ---- parsing -----------------------------------------------------------------


def _parsed(raw: Column) -> Column:
    """Struct of ``parsed_ok`` and the three fields of an answer.

    An answer counts if it is one JSON object with all keys; a key with a null
    value is present.  The text is parsed inside brackets, so anything after
    the object breaks the array instead of being passed over.  Lambdas bind the
    unwrapped text and the parsed array, so each is computed once per row.
    """
    wanted = F.array(*[F.lit(k) for k in KEYS])

    def read(body: Column) -> Column:
        return F.struct(
            F.from_json(F.concat(F.lit("["), body, F.lit("]")), _ANSWER, _STRICT_JSON).alias("items"),
            F.size(F.array_intersect(F.json_object_keys(body), wanted)).alias("present"),
        )

    def decide(answer: Column) -> Column:
        ok = F.coalesce((F.size(answer["items"]) == 1) & (answer["present"] == len(KEYS)), F.lit(False))
        first = F.try_element_at(answer["items"], F.lit(1))
        return F.struct(ok.alias("parsed_ok"), *[F.when(ok, first[k]).alias(k) for k in KEYS])

    return F.transform(F.transform(F.array(strip_code_fence(raw)), read), decide)[0]


def try_parse(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``parsed_ok`` and the three fields, null where the answer is unreadable."""
    return responses.withColumn("__a", _parsed(F.col(raw))).select(*responses.columns, "__a.*")


def with_fallback(parsed: DataFrame) -> DataFrame:
    return parsed.withColumns(
        {k: F.when(F.col("parsed_ok"), F.col(k)).otherwise(v) for k, v in zip(KEYS, FALLBACK)}
    )


def parse_extractions(responses: DataFrame) -> DataFrame:
    """Fields of each answer, or the stand-in record."""
    return with_fallback(try_parse(responses)).drop("raw")


def parse_attempts(responses: DataFrame, first: str = "raw", second: str = "raw_retry") -> DataFrame:
    """First readable of two answers, and which attempt it was (0 for none)."""
    one = try_parse(responses, first).withColumnsRenamed({k: f"{k}__1" for k in KEYS}).withColumnRenamed("parsed_ok", "ok__1")
    two = try_parse(one, second)
    chosen = two.withColumns(
        {
            **{k: F.when(F.col("ok__1"), F.col(f"{k}__1")).otherwise(F.col(k)) for k in KEYS},
            "attempt": F.when(F.col("ok__1"), 1).when(F.col("parsed_ok"), 2).otherwise(0),
            "parsed_ok": F.col("ok__1") | F.col("parsed_ok"),
        }
    )
    return with_fallback(chosen).drop("ok__1", *[f"{k}__1" for k in KEYS], first, second)


class AnswersMissing(RuntimeError):
    """Some prompts got no answer; those that did are in the log."""


def logged_answers(
    prompts: DataFrame, answer: Complete, log: str, key: str = "review_id", rows: int = 64, slices: int = 16
) -> DataFrame:
    """Key and raw answer of each prompt, each different prompt asked once for as long as the log exists.

    ``log`` is a folder that all executors share; answers lie there under the
    digest of their prompt.  ``answer`` gets up to ``rows`` prompts at a time.  When
    it raises, those prompts stay open and the others go on; after the slice
    ``AnswersMissing`` is raised, and a rerun asks only what is open.  A driver that
    dies loses the answers of one slice of the prompts, an executor those of
    its running tasks.  A null answer counts as none.
    """
    spark = prompts.sparkSession
    digest = F.sha2(F.to_json(F.array("system_text", "user_text")), 256)
    named = cut_lineage(prompts.select(key, "system_text", "user_text", digest.alias("digest")))
    spark.createDataFrame([], "digest string, raw string").write.mode("append").parquet(log)
    held = spark.read.parquet(log)
    todo = cut_lineage(named.drop(key).dropDuplicates(["digest"]).join(held.select("digest"), "digest", "left_anti"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                few = batch.iloc[at : at + rows].reset_index(drop=True)
                try:
                    raw, error = list(answer(few[["system_text", "user_text"]])), None
                except Exception as failure:  # whatever the service raises, the others are asked
                    raw, error = [None] * len(few), f"{type(failure).__name__}: {failure}"
                yield pd.DataFrame({"digest": few["digest"], "raw": raw, "error": [error] * len(few)})

    for turn in range(slices):
        part = todo.where(F.pmod(F.xxhash64("digest"), F.lit(slices)) == turn)
        if part.isEmpty():
            continue
        given = cut_lineage(part.mapInPandas(run, "digest string, raw string, error string"))
        given.where(F.col("raw").isNotNull()).select("digest", "raw").write.mode("append").parquet(log)
        failed = given.where(F.col("error").isNotNull())
        example = failed.first()
        if example is not None:
            raise AnswersMissing(f"{failed.count()} prompts of a slice got no answer, for instance: {example['error']}")
    # a driver lost between two writes may leave an answer twice
    answers = spark.read.parquet(log).groupBy("digest").agg(F.min("raw").alias("raw"))
    return named.select(key, "digest").join(answers, "digest", "left").select(key, "raw")


def extract(reviews: DataFrame, answer: Complete, key: str = "review_id", log: str | None = None) -> DataFrame:
    """Ask for each review, ask once more where the answer is unreadable.

    Answers are paid for, so each round is checkpointed and never asked twice.
    With a folder ``log`` the answers of both rounds outlive the job that asked.
    """

    def asked(some: DataFrame, turn: str) -> DataFrame:
        return logged_answers(some, answer, f"{log}/{turn}", key) if log else complete(some, answer, key)

    prompts = prompt_build(reviews)
    first = try_parse(cut_lineage(asked(prompts, "first")))
    unreadable = prompts.join(first.where(~F.col("parsed_ok")).select(key), key, "left_semi")
    second = try_parse(cut_lineage(asked(unreadable, "second")))
    both = first.where(F.col("parsed_ok")).unionByName(second)
    return with_fallback(both).drop("raw")


def extraction_quality(extracted: DataFrame) -> DataFrame:
    """Rows per pair of labels, and whether each label is an allowed one."""
    return (
        extracted.groupBy("sentiment", "complaint_category", "parsed_ok")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "sentiment_ok": F.coalesce(F.col("sentiment").isin(*SENTIMENTS), F.lit(False)),
                "category_ok": F.coalesce(F.col("complaint_category").isin(*COMPLAINTS), F.lit(False)),
            }
        )
    )


# ---- findings ----------------------------------------------------------------


def extraction_join(reviews: DataFrame, extracted: DataFrame, key: str = "review_id") -> DataFrame:
    """Reviews with their extracted fields, matched on the review's key."""
    return reviews.join(extracted.select(key, *KEYS), key)


def complaint_counts(joined: DataFrame, by: str) -> DataFrame:
    """Rows per group and complaint; rows without either are left out.

    Missing complaints go after the count: tested before, the parsing of the
    answers would run once more for the test.
    """
    return (
        joined.where(F.col(by).isNotNull())
        .groupBy(by, "complaint_category")
        .agg(F.count("complaint_category").alias("n"))
        .where(F.col("n") > 0)
    )


def complaint_matrix(joined: DataFrame, by: str, categories: Sequence[str] = COMPLAINTS) -> DataFrame:
    """One row per group and one column per complaint, absent pairs 0.

    Labels outside the list are counted in ``unlisted``.
    """
    category = F.col("complaint_category")
    return (
        joined.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            *[F.count_if(category == c).alias(c) for c in categories],
            F.count_if(~category.isin(*categories)).alias("unlisted"),
            F.count(category).alias("__n"),
        )
        .where(F.col("__n") > 0)
        .drop("__n")
    )


def complaints_by_age_bucket(joined: DataFrame) -> DataFrame:
    return complaint_matrix(joined.withColumn("age_bucket", age_bucket(F.col("age"))), "age_bucket")


def top_complaint(joined: DataFrame, by: str = "department_name") -> DataFrame:
    """Most frequent complaint of each group, the first by name on ties."""
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("complaint_category").alias("category")))
    return complaint_counts(joined, by).groupBy(by).agg(best.alias("b")).select(
        by, F.col("b.category").alias("top_complaint"), (-F.col("b.order")).alias("top_count")
    )


def recommendations(joined: DataFrame, by: str = "department_name") -> DataFrame:
    """Advice per group whose main complaint is not ``none``.

    ``advice`` is a sentence, null where there is none for the complaint;
    ``notice`` is a labelled count, without a label where there is none.
    """
    top = top_complaint(joined, by).where((F.col("top_complaint") != "none") & (F.col("top_count") > 0))

    def looked_up(texts: dict[str, str]) -> Column:
        found = F.lit(None).cast("string")
        for complaint, text in texts.items():
            found = F.when(F.col("top_complaint") == complaint, text).otherwise(found)
        return found

    count = F.format_string("%s %s complaints", F.col("top_count"), F.col("top_complaint"))
    notice = F.concat(F.col(by), F.lit(": "), F.concat_ws(" - ", looked_up(NOTICE), count))
    return top.withColumns({"advice": looked_up(ADVICE), "notice": notice})


def review_explorer(
    joined: DataFrame, department: str = "All", sentiment: str = "All", n: int = 50
) -> DataFrame:
    """First reviews by id that match the filters, with the number of matches."""
    chosen = joined
    if department != "All":
        chosen = chosen.where(F.col("department_name") == department)
    if sentiment != "All":
        chosen = chosen.where(F.col("sentiment") == sentiment)
    matches = chosen.agg(F.count(F.lit(1)))
    return (
        chosen.select("review_id", "rating", "department_name", "age", "sentiment", "complaint_category", "review_text")
        .orderBy("review_id")
        .limit(n)
        .withColumn("matches", matches.scalar())
    )
