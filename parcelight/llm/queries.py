"""Each text operator applied to its whole table, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelight.llm import (
    collocations,
    fingerprints,
    lexical_search,
    license_scan,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    suffix_dedup,
    toxicity,
)
from parcelight.llm.common import documents, table


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_digest(documents(spark, folder))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, folder)).drop("__row")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, folder))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.quality_grades(documents(spark, folder), table(spark, folder, "labels"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_digest(documents(spark, folder))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeat_digest(documents(spark, folder))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(documents(spark, folder))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, folder))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(documents(spark, folder))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, folder), table(spark, folder, "labels"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(documents(spark, folder), table(spark, folder, "benchmark"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digest(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_secret_scan": op5_secret_scan,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
}

SQL: dict[str, str] = {
    "op8_mixing": mixing.MIXING_SQL,
    "op11_lexical_search": lexical_search.SEARCH_SQL,
    "op12_collocations": collocations.COLLOCATION_SQL,
    "op13_sharding": sharding.SHARDING_SQL,
}
