"""Registered queries that store rows and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelight.operators import quality
from parcelight.plans import extraction
from parcelight.registry.extraction import EXTRACTED_SQL, extracted
from parcelight.registry.reviews import CONTENT, CSV_COLUMNS_SQL, RAW, in_written_order, raw_names
from parcelight.registry.spec import Spec
from parcelight.session import shared_path
from parcelight.sources.fixtures import Inputs
from parcelight.sources.readers import register_view, resolve_source, scan_csv, scan_table
from parcelight.sources.sinks import commented, create_table_if_absent, replace_table, write_csv


def _table_roundtrip(i: Inputs) -> DataFrame:
    """A table that is created twice keeps its rows, one that is replaced has the
    last; both are read by name and by SQL."""
    once, twice = i.apparel_reviews_raw, i.apparel_reviews_reloaded
    mark = uuid.uuid4().hex
    kept, replaced, view = (f"parcelight_{name}_{mark}" for name in ("kept", "replaced", "view"))
    at = shared_path(i.spark, "kept")
    loads = [create_table_if_absent(commented(once), kept, at), create_table_if_absent(commented(twice), kept, at)]
    at = shared_path(i.spark, "replaced")
    loads += [replace_table(once, replaced, path=at), replace_table(twice, replaced, path=at)]
    register_view(scan_table(i.spark, replaced), view)
    by_name = scan_table(i.spark, kept).groupBy("department_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("ratings"), F.max("review_id").alias("last_id")
    )
    by_sql = i.spark.sql(
        f"select department_name, count(*) as n, sum(rating) as ratings, max(review_id) as last_id from {view} group by 1"
    )

    def told(df: DataFrame, origin: str, first: int, second: int) -> DataFrame:
        return df.select(F.lit(origin).alias("origin"), "*", F.lit(first).alias("first_load"), F.lit(second).alias("second_load"))

    return told(by_name, "kept", *loads[:2]).unionByName(told(by_sql, "replaced", *loads[2:]))


def _loaded_sql(origin: str, source: str, first: str) -> str:
    return f"""select '{origin}' as origin, department_name, count(*) as n, cast(sum(rating) as bigint) as ratings,
        max(review_id) as last_id, (select cast(count(*) as int) from {first}) as first_load,
        (select cast(count(*) as int) from {source}) as second_load from {source} group by department_name"""


_ANSWERS = T.StructType(
    [T.StructField("review_id", T.LongType()), *[T.StructField(k, T.StringType()) for k in extraction.KEYS],
     T.StructField("parsed_ok", T.IntegerType())]
)


def _resolved_source(i: Inputs) -> DataFrame:
    """A CSV of extracted answers, found after a table and a path that are not
    there; an optional source that is nowhere is none."""
    path = shared_path(i.spark, "answers")
    answers = extracted(i).withColumn("parsed_ok", F.col("parsed_ok").cast("int"))
    write_csv(answers.select(*_ANSWERS.names), f"{path}.csv")
    found = resolve_source(i.spark, ["parcelight_not_there", f"{path}/not-there", f"{path}-no.csv", f"{path}.csv"], csv_schema=_ANSWERS)
    none = resolve_source(i.spark, [f"{path}-no.csv"], required=False, csv_schema=_ANSWERS)
    return found.withColumn("optional_found", F.lit(int(none is not None)))


def _export_tidy(i: Inputs) -> DataFrame:
    """The export with its row numbers, which go."""
    path = shared_path(i.spark, "export")
    write_csv(i.apparel_reviews_raw.withColumnsRenamed(raw_names()), path)
    return quality.tidy_names(scan_csv(i.spark, path, in_written_order(i)))


SPECS: dict[str, Spec] = {
    "table_roundtrip": Spec(
        _table_roundtrip,
        "apparel_reviews_reloaded",
        _loaded_sql("kept", RAW, RAW) + " union all " + _loaded_sql("replaced", "apparel_reviews_reloaded", RAW),
    ),
    "resolved_source": Spec(
        _resolved_source,
        "llm_responses",
        EXTRACTED_SQL
        + f"select review_id, {', '.join(extraction.KEYS)}, cast(ok as int) as parsed_ok, 0 as optional_found from extracted",
    ),
    "export_tidy": Spec(
        _export_tidy, RAW, f", export as ({CSV_COLUMNS_SQL}) select {', '.join(CONTENT)} from export"
    ),
}
