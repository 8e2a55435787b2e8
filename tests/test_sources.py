import pytest
from pyspark.sql import types as T

from parcelight.sources import readers, schemas, sinks


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'he said "no"\nand left', 39), (2, " padded ", None), (3, "NA", 5), (4, "", 6), (5, "a,b", 7)]
    schema = T.StructType([T.StructField("Clothing ID", T.LongType()), T.StructField("Review Text", T.StringType()), T.StructField("Age", T.IntegerType())])
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame(rows, schema), path, rows_per_file=2)
    got = {r[0]: (r[1], r[2]) for r in readers.scan_csv(spark, path, schema).collect()}
    assert got == {1: (rows[0][1], 39), 2: (" padded ", None), 3: (None, 5), 4: (None, 6), 5: ("a,b", 7)}


def test_csv_tokens_and_float_ints(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('Unnamed: 0,Clothing ID,Age,Title\n0,767,39.0,nan\n1,9007199254740993,,N/A\n2,3,NULL,"x ""y"""\n')
    schema = T.StructType(
        [T.StructField(n, k) for n, k in (("Unnamed: 0", T.LongType()), ("Clothing ID", T.LongType()), ("Age", T.IntegerType()), ("Title", T.StringType()))]
    )
    got = [tuple(r) for r in readers.scan_csv(spark, str(file), schema).orderBy("`Unnamed: 0`").collect()]
    assert got == [(0, 767, 39, None), (1, 9007199254740993, None, None), (2, 3, None, 'x "y"')]


def test_resolve_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert readers.resolve_source(spark, [str(tmp_path / "none"), path]).count() == 3
    assert readers.resolve_source(spark, [str(tmp_path / "none"), "no_table"], required=False) is None
    with pytest.raises(FileNotFoundError):
        readers.resolve_source(spark, [str(tmp_path / "none")])


def test_resolve_csv(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    path = str(tmp_path / "t.csv")
    sinks.write_csv(spark.createDataFrame([(1, "x"), (2, "NA")], schema), path)
    found = readers.resolve_source(spark, ["no_table", str(tmp_path / "none.csv"), path], csv_schema=schema)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "x"), (2, None)]
    assert readers.resolve_source(spark, [str(tmp_path / "none.csv")], required=False, csv_schema=schema) is None
    with pytest.raises(ValueError):
        readers.resolve_source(spark, [path])


def test_tables_at_a_path(spark, tmp_path):
    once, swapped = str(tmp_path / "once"), str(tmp_path / "swapped")
    assert sinks.create_table_if_absent(spark.range(3), "kept_there", once) == 3
    assert sinks.create_table_if_absent(spark.range(9), "kept_there", once) == 3
    assert sinks.replace_table(spark.range(4), "swapped_there", path=swapped) == 4
    assert sinks.replace_table(spark.range(5), "swapped_there", path=swapped) == 5
    assert spark.read.parquet(once).count() == 3 and spark.read.parquet(swapped).count() == 5


def test_tables(spark):
    assert sinks.create_table_if_absent(spark.range(3), "kept") == 3
    assert sinks.create_table_if_absent(spark.range(9), "kept") == 3
    assert sinks.replace_table(spark.range(4), "swapped") == 4
    assert sinks.replace_table(spark.range(5), "swapped") == 5
    assert readers.resolve_source(spark, ["nowhere", "swapped"]).count() == 5


def test_index_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "chunk_id string, v int")
    assert sinks.append_to_index(spark, path, rows).count() == 2
    more = spark.createDataFrame([("b", 9), ("c", 3)], "chunk_id string, v int")
    got = sinks.append_to_index(spark, path, more)
    got = sinks.append_to_index(spark, path, more)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_ddl_text():
    text = schemas.create_table_text("reviews", schemas.REVIEWS)
    assert text.startswith("CREATE TABLE IF NOT EXISTS reviews (\n    clothing_id INTEGER,")
    assert text.endswith("age_bucket VARCHAR  -- Derived: age band\n);")


def test_views_by_name(spark):
    readers.register_view(spark.range(2), "two_rows")
    assert readers.scan_table(spark, "two_rows").count() == 2
