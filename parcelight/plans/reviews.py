"""Review analytics: cleaned reviews with derived columns, and six questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.functions import text
from parcelight.functions.numbers import round_half_up
from parcelight.operators.quality import clean_reviews
from parcelight.operators.sampling import top_rows


def with_derived(df: DataFrame) -> DataFrame:
    """Add the word count and the age band."""
    return df.withColumns(
        {
            "review_length": text.word_count(F.col("review_text")),
            "age_bucket": text.age_bucket(F.col("age")),
        }
    )


def review_table(raw: DataFrame) -> DataFrame:
    """Cleaned reviews with derived columns."""
    return with_derived(clean_reviews(raw))


def _n() -> Column:
    return F.count(F.lit(1)).alias("review_count")


def _avg_rating() -> Column:
    return round_half_up(F.avg("rating"), 2).alias("avg_rating")


def _recommend_pct() -> Column:
    return round_half_up(F.avg("recommended_ind") * 100, 1).alias("recommend_rate_pct")


def rating_by_department(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("department_name")
        .agg(_avg_rating(), _recommend_pct(), _n())
        .orderBy(F.desc("avg_rating"), "department_name")
    )


def rating_by_age_bucket(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("age_bucket")
        .agg(_avg_rating(), _n())
        .orderBy(text.age_bucket_rank(F.col("age_bucket")))
    )


def length_by_recommendation(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("recommended_ind")
        .agg(round_half_up(F.avg("review_length"), 1).alias("avg_review_length"), _n())
        .withColumn("recommended", text.yes_no(F.col("recommended_ind")))
        .orderBy(F.desc("recommended_ind"))
    )


def length_statistics(reviews: DataFrame) -> DataFrame:
    return (
        reviews.groupBy("recommended_ind")
        .agg(
            F.min("review_length").alias("min_len"),
            round_half_up(F.avg("review_length"), 1).alias("avg_len"),
            F.max("review_length").alias("max_len"),
            round_half_up(F.stddev_samp("review_length"), 1).alias("std_len"),
            F.count(F.lit(1)).alias("cnt"),
        )
        .orderBy(F.desc("recommended_ind"))
    )


def lowest_recommended_classes(reviews: DataFrame, n: int = 5) -> DataFrame:
    """Classes with the lowest share of recommendations, ties by name."""
    by_class = reviews.groupBy("class_name").agg(_recommend_pct(), _avg_rating(), _n())
    return top_rows(by_class, [F.asc("recommend_rate_pct"), F.asc("class_name")], n)


def bottom_class_ratings(reviews: DataFrame, n: int = 5, min_reviews: int = 20) -> DataFrame:
    """Rating distribution of the least recommended classes with enough reviews.

    The reviews are read once, down to (class, rating) counts.  A class carries
    its counts, one for each rating, through the choice of classes.
    """
    cells = reviews.groupBy("class_name", "rating").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("recommended_ind").alias("recommended")
    )
    classes = (
        cells.groupBy("class_name")
        .agg(
            F.sum("cnt").alias("n"),
            F.sum("recommended").alias("r"),
            F.collect_list(F.struct("rating", "cnt", "recommended")).alias("ratings"),
        )
        .where((F.col("n") >= min_reviews) & F.col("class_name").isNotNull())
    )
    bottom = top_rows(classes, [F.asc(F.col("r") / F.col("n")), F.asc("class_name")], n)
    return (
        bottom.select("class_name", F.inline("ratings"))
        .select(
            "class_name",
            "rating",
            "cnt",
            round_half_up(F.col("recommended") / F.col("cnt") * 100, 1).alias("recommend_rate_pct"),
        )
        .orderBy("class_name", F.desc("rating"))
    )


def length_summary(reviews: DataFrame) -> DataFrame:
    """Range and mean of review length, rating and age."""
    return reviews.agg(
        F.min("review_length").alias("min_length"),
        F.max("review_length").alias("max_length"),
        round_half_up(F.avg("review_length"), 1).alias("mean_length"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
    )


def age_bucket_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("age_bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("age_bucket")
