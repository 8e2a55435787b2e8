"""From source files to stored tables: reviews, order mart, review index."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelight.operators.orders import order_mart
from parcelight.plans.retrieval import review_index
from parcelight.plans.reviews import review_table
from parcelight.sources.readers import resolve_source, scan_csv
from parcelight.sources.schemas import RAW_REVIEWS, ROW_NUMBER_HEADER
from parcelight.sources.sinks import append_to_index, commented, create_table_if_absent, replace_table

ORDER_STAR = ("orders", "items", "products", "sellers", "customers", "reviews")


def read_reviews(spark: SparkSession, csv_path: str) -> DataFrame:
    """The review export; its row numbers become the key ``review_id``."""
    return scan_csv(spark, csv_path, RAW_REVIEWS).withColumnRenamed(ROW_NUMBER_HEADER, "review_id")


def store_reviews(spark: SparkSession, csv_path: str, table: str = "reviews") -> int:
    """Clean, derive, describe and store the reviews; returns the row count.

    A table that is already there stays as it is.
    """
    return create_table_if_absent(commented(review_table(read_reviews(spark, csv_path))), table)


def store_order_mart(
    spark: SparkSession, sources: Mapping[str, Iterable[str]], table: str = "order_mart"
) -> int:
    """Build the mart from the first source that exists of each table."""
    missing = [name for name in ORDER_STAR if name not in sources]
    if missing:
        raise KeyError(f"no sources given for {missing}")
    star = {name: resolve_source(spark, sources[name]) for name in ORDER_STAR}
    return replace_table(order_mart(**star), table)


def store_review_index(
    spark: SparkSession, reviews: DataFrame, path: str, encoder: DataFrame
) -> DataFrame:
    """Chunk and embed reviews and append what the index does not hold yet."""
    return append_to_index(spark, path, review_index(reviews, encoder))
