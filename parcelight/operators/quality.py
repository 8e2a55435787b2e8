"""Profiling and cleaning of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions.numbers import clip, share_pct
from parcelight.sources.schemas import REVIEW_HEADER, ROW_NUMBER_HEADER, ddl_type, with_comments


# ---- profiling ---------------------------------------------------------------


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column with its type and the shape of the table."""
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
            )
            for i, (name, kind) in enumerate(kinds)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.lit(len(kinds)).alias("n_columns"), F.explode(rows).alias("c"))
        .select("c.position", "c.column_name", "c.data_type", "n_rows", "n_columns")
    )


def schema_ddl(df: DataFrame) -> DataFrame:
    """One row per column: storage type, comment and the rows loaded."""
    fields = with_comments(df.schema).fields
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(ddl_type(f.dataType)).alias("sql_type"),
                F.lit(f.metadata.get("comment", "")).alias("comment"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.explode(rows).alias("c"))
        .select("c.position", "c.column_name", "c.sql_type", "c.comment", "n_rows")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, counted in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    return (
        counts.unpivot("__rows", df.columns, "column_name", "null_count")
        .select(
            "column_name",
            "null_count",
            share_pct(F.col("null_count"), F.col("__rows")).alias("null_pct"),
        )
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, nulls left out, one pass for all columns."""
    as_text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        as_text.unpivot([], list(columns), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def row_digest(columns: Sequence[str]) -> Column:
    """256-bit digest of a row in which null equals null."""
    text = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    return F.sha2(text, 256)


def duplicate_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Extra copies of rows that agree on ``columns``.

    Only digests are shuffled, and copies meet in the map-side combine first.
    """
    return (
        df.select(row_digest(columns).alias("digest"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("digest").alias("n_distinct"),
        )
        .select(
            "n_rows",
            (F.col("n_rows") - F.col("n_distinct")).alias("duplicate_rows"),
            share_pct(F.col("n_rows") - F.col("n_distinct"), F.col("n_rows")).alias("duplicate_pct"),
        )
    )


def _rating_outlier() -> Column:
    return (F.col("rating") < 1) | (F.col("rating") > 5)


def _age_outlier() -> Column:
    return (F.col("age") <= 0) | (F.col("age") > 120)


def outlier_profile(df: DataFrame) -> DataFrame:
    """Rows per out-of-range rating and age."""
    offenders = F.array_compact(
        F.array(
            *[
                F.when(
                    bad, F.struct(F.lit(name).alias("column_name"), F.col(name).alias("value"))
                )
                for name, bad in (("rating", _rating_outlier()), ("age", _age_outlier()))
            ]
        )
    )
    return (
        df.where(_rating_outlier() | _age_outlier())
        .select(F.explode(offenders).alias("o"))
        .groupBy("o.column_name", "o.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---- cleaning ----------------------------------------------------------------

TEXT_COLUMNS = ("title", "review_text")
CATEGORY_COLUMNS = ("division_name", "department_name", "class_name")


def tidy_names(df: DataFrame) -> DataFrame:
    """Drop the export's row number and use snake-case names."""
    return df.drop(ROW_NUMBER_HEADER).withColumnsRenamed(REVIEW_HEADER)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with a text and all categories; plain null tests reach the scan."""
    complete = F.col("review_text").isNotNull()
    for c in CATEGORY_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete)


def drop_copies(df: DataFrame, key: str | None = "review_id", texts: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Keep one of each set of equal rows; the key, which numbers the rows and
    is not part of their content, is the lowest of the set.

    Rows meet by their digest.  The columns in ``texts`` are carried along only
    for who reads them afterwards; a question about other columns shuffles no text.
    """
    key = key if key in df.columns else None
    content = [c for c in df.columns if c != key]
    carried = [c for c in content if c in texts]
    narrow = [c for c in content if c not in texts]
    found = [F.any_value(c).alias(c) for c in carried]
    kept = [F.min(key).alias(key)] if key else [F.count(F.lit(1)).alias("__copies")]
    met = df.withColumn("__digest", row_digest(content)).groupBy("__digest", *narrow).agg(*kept, *found)
    return met.select(*df.columns)


def clip_rating(df: DataFrame) -> DataFrame:
    return df.withColumn("rating", clip(F.col("rating"), 1, 5))


def clip_age(df: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Limit ages to 18..100, but only if any age is impossible.

    ``evidence`` is where impossible ages are looked for; it may hold more
    copies of the same rows than ``df``, which saves repeating their removal.
    """
    searched = evidence if evidence is not None else df
    any_bad = searched.where(_age_outlier()).agg(F.count(F.lit(1)) > 0)
    limited = F.when(any_bad.scalar(), clip(F.col("age"), 18, 100)).otherwise(F.col("age"))
    return df.withColumn("age", limited)


def clean_reviews(df: DataFrame, key: str | None = "review_id") -> DataFrame:
    """Names, missing values, copies and ranges, in that order."""
    complete = drop_incomplete(tidy_names(df))
    return clip_age(clip_rating(drop_copies(complete, key)), evidence=complete)


def clean_audit(df: DataFrame, key: str | None = "review_id") -> DataFrame:
    """Rows before and after each cleaning step, from one pass."""
    named = tidy_names(df)
    has_text = F.col("review_text").isNotNull()
    complete = has_text
    for c in CATEGORY_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    content = [c for c in named.columns if c != key]
    marked = named.select(
        has_text.alias("has_text"),
        complete.alias("complete"),
        F.when(complete, row_digest(content)).alias("digest"),
        (complete & _rating_outlier()).alias("bad_rating"),
        (complete & _age_outlier()).alias("bad_age"),
    )
    # Group by content first, so that copies of a row are counted once below.
    rows = marked.groupBy("digest", "has_text", "complete", "bad_rating", "bad_age").agg(
        F.count(F.lit(1)).alias("copies")
    )
    kept = F.col("complete")
    totals = rows.agg(
        F.sum("copies").alias("n_raw"),
        F.sum(F.when(F.col("has_text"), F.col("copies")).otherwise(0)).alias("n_text"),
        F.sum(F.when(kept, F.col("copies")).otherwise(0)).alias("n_complete"),
        F.count_if(kept).alias("n_unique"),
        F.count_if(kept & F.col("bad_rating")).alias("bad_ratings"),
        F.count_if(kept & F.col("bad_age")).alias("bad_ages"),
    )
    steps = (
        ("missing_text", "n_raw", "n_text"),
        ("missing_category", "n_text", "n_complete"),
        ("copies", "n_complete", "n_unique"),
        ("ranges", "n_unique", "n_unique"),
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("step_name"),
                F.coalesce(F.col(before), F.lit(0)).cast("bigint").alias("rows_before"),
                F.coalesce(F.col(after), F.lit(0)).cast("bigint").alias("rows_after"),
                (F.col("bad_ratings") if name == "ranges" else F.lit(0)).cast("bigint").alias("ratings_clipped"),
                (F.col("bad_ages") if name == "ranges" else F.lit(0)).cast("bigint").alias("ages_out_of_range"),
            )
            for i, (name, before, after) in enumerate(steps)
        ]
    )
    return totals.select(F.inline(listed)).withColumn(
        "rows_dropped", F.col("rows_before") - F.col("rows_after")
    )


# ---- lenient parsing ---------------------------------------------------------


def lenient_timestamp(text: Column) -> Column:
    """Timestamp without zone; text that is none gives null."""
    return text.try_cast("timestamp_ntz")


def lenient_number(text: Column) -> Column:
    return text.try_cast("double")


def split_by_kind(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and text columns of a frame."""
    from pyspark.sql import types as T

    fields = [f for f in df.schema.fields if f.name not in leave_out]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    textual = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, textual


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls and add columns that are missing."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.na.fill(present).withColumns(absent) if absent else df.na.fill(present)
