"""Every registered query with SQL gives exactly the rows that DuckDB gives."""

import os

import duckdb
import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries

# The text operators are tested in tests/llm.
ORACLES = {name: sql for name, sql in oracle_sql().items() if name not in LLM_QUERIES}
# Model training, which SQL cannot express.
ROWS_ONLY = {
    "train_logistic", "train_forest", "train_light_forest", "feature_importances",
    "score_orders", "score_what_if",
}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{folder}/{name}'")
    return connection


def _canonical(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql_or_a_reason():
    assert set(queries()) - set(LLM_QUERIES) == set(ORACLES) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, folder, duck):
    ours = queries()[name](spark, folder)
    theirs = duck.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    rows = [tuple(r) for r in ours.collect()]
    assert _canonical(ours.columns, rows) == _canonical(columns, theirs.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
