"""What a forest shuffles does not stay on disk until the driver happens to collect its garbage."""

import time

from pyspark.sql import functions as F

from parcelight.operators import forest, history
from parcelight.plans import modeling
from parcelight.registry.modeling import _parts
from parcelight.session import without_old_shuffles


def shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def no_more_than(spark, before):
    """Files go in the background."""
    for _ in range(50):
        if shuffled(spark) <= before:
            return True
        time.sleep(0.2)
    return False


def test_jobs_leave_no_shuffle_files(spark, tmp_path):
    before = shuffled(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with without_old_shuffles(spark):
        counted.write.parquet(str(tmp_path / "t"))
    assert no_more_than(spark, before) and spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_model_rows_are_cut_off_without_their_shuffles(spark, monkeypatch):
    monkeypatch.setattr(history, "is_train", lambda rows, order_by: F.col("order_id") < 80)  # shuffles of its own
    before = shuffled(spark)
    frame = spark.range(100).repartition(7).select(F.col("id").alias("order_id"))
    early, late = _parts(frame, ["order_id"])
    assert no_more_than(spark, before)
    assert (early.count(), late.count()) == (80, 20)


def test_trees_are_dealt_out_by_their_rows(spark, monkeypatch):
    made = [(i, float(i * 37 % 101), "xy"[i % 2], int(i * 37 % 101 > 60)) for i in range(400)]
    rows = spark.createDataFrame(made, "order_id int, a double, c string, target_late int").repartition(2).checkpoint()
    monkeypatch.setattr(modeling, "SPARK_ML_PAIRS", 1)
    monkeypatch.setattr(forest, "SHUFFLED_BYTES", 400 * 4 * 2)
    at_once = []
    kept = forest._branches
    monkeypatch.setattr(forest, "_branches", lambda b, tops, layout: at_once.append(len(tops)) or kept(b, tops, layout))
    model = modeling.fit_forest(rows, trees=5, depth=3)
    assert at_once == [2, 2, 1] and model.stages[-1].getNumTrees == 5
