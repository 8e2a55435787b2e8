import random

import pytest
from pyspark.sql import types as T

from parcelight.sources.quoted_csv import csv_records, scan_split_csv
from parcelight.sources.readers import scan_csv

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("note", T.StringType())]
)
PARTS = ['""', "\n", "\n\n", ",", "x", "two words", "é", '""\n""', " "]


def _quoted(rng):
    return '"' + "".join(rng.choice(PARTS) for _ in range(rng.randrange(12))) + '"'


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "0"), strict=True)]
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_ranges_read_what_the_whole_file_gives(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    rows = [f"{n},{_quoted(rng)},{rng.choice(['NA', 'plain', _quoted(rng)])}" for n in range(150)]
    for name in ("a", "b"):  # two files, one of which ends without a line break
        (tmp_path / f"{name}.csv").write_text('id,"te\nxt",note\n' + "\n".join(rows) + ("\n\n" if name == "a" else ""), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    want = sorted(map(str, scan_csv(spark, str(tmp_path), SCHEMA).collect()))
    small_ranges(size)
    split = scan_split_csv(spark, str(tmp_path), SCHEMA)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2
    assert sorted(map(str, split.collect())) == want and len(want) == 300


def test_one_field_over_many_ranges(spark, tmp_path, small_ranges):
    text = "line\n" * 400
    (tmp_path / "a.csv").write_text(f'id,text,note\n1,"{text}",x\n2,y,z\n')
    small_ranges(50)
    got = scan_split_csv(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r["id"], r["text"], r["note"]) for r in got) == [(1, text, "x"), (2, "y", "z")]


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,note\n")
    (tmp_path / "b.csv").write_text("")
    assert scan_split_csv(spark, str(tmp_path), SCHEMA).collect() == []
    assert csv_records(spark, str(tmp_path)).count() == 1
