"""Scans: CSV, tables, first source that exists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in a CSV field.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Quotes are doubled and fields may hold line breaks, so one file is one task:
# write many files of moderate size (see ``sinks.write_csv``).
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def null_tokens_to_null(value: Column) -> Column:
    return F.when(~value.isin(*NULL_TOKENS), value)


def typed_fields(schema: T.StructType) -> list[Column]:
    """Fields read as text in their own types; every missing-value token becomes null."""

    def typed(field: T.StructField) -> Column:
        value = null_tokens_to_null(F.col(f"`{field.name}`"))
        if isinstance(field.dataType, T.IntegralType):
            # whole numbers next to missing ones are often written as 39.0
            value = value.cast("decimal(38,6)")
        return value.cast(field.dataType).alias(field.name)

    return [typed(f) for f in schema.fields]


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; every missing-value token becomes null.

    Fields are read as text first, so that a token in a number column is a null
    and not a reading error, and cast after that.  A file is one task here;
    ``quoted_csv.scan_split_csv`` splits large files.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.options(**CSV_OPTIONS).schema(as_text).csv(path)
    return raw.select(*typed_fields(schema))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a frame readable by name from SQL."""
    df.createOrReplaceTempView(name)
    return df


def resolve_source(
    spark: SparkSession, candidates: Iterable[str], required: bool = True, csv_schema: T.StructType | None = None
) -> DataFrame | None:
    """First candidate that exists: a table name, a parquet path, or a path that
    ends in ``.csv``, which is read with ``csv_schema``."""
    tried = list(candidates)
    for name in tried:
        try:
            if name.endswith(".csv"):
                if csv_schema is None:
                    raise ValueError(f"{name} needs a schema")
                return scan_csv(spark, name, csv_schema)
            if "/" in name:
                return spark.read.parquet(name)
            if spark.catalog.tableExists(name):
                return spark.table(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if required:
        raise FileNotFoundError(f"none of these sources exists: {tried}")
    return None
