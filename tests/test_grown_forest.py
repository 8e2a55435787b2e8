"""Forests of many rows: the same splits as Spark ML's, wherever a node is split, and every tree whole."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from parcelight.operators import forest
from parcelight.plans import model_tables, modeling

_KINDS = "xyz"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    made = []
    for i in range(3000):
        a, b, c = float(rng.normal()), int(rng.integers(0, 6)), _KINDS[rng.integers(0, 3)]
        late = rng.random() < 1 / (1 + np.exp(-(2 * a + b - 3 + (c == "y"))))
        made.append((i, a, b, c, int(late)))
    return spark.createDataFrame(made, "order_id int, a double, b int, c string, target_late int").repartition(3).checkpoint()


def described(tree):
    return tree.toDebugString.split("\n", 1)[1]


def whole_tree(rows, depth=7):
    """One tree that draws every row once and looks at every column."""
    prepared = Pipeline(stages=modeling.preprocessing(["a", "b"], ["c"])).fit(rows)
    classifier = RandomForestClassifier(labelCol="target_late", weightCol="weight", numTrees=1, maxDepth=depth, minInstancesPerNode=5, seed=42)
    ready = modeling.with_weight(prepared.transform(rows), 1.0, 2.0)
    grown = forest.fit_grown_forest(ready, ["a__s", "b__s"], {"c__x": 3}, classifier, (1.0, 2.0), rows.count(), chosen=5, drawn=False)
    return grown, ready


@pytest.mark.parametrize("local", [10**6, 300])
def test_a_tree_of_all_rows_is_that_of_spark_ml(rows, monkeypatch, local):
    monkeypatch.setattr(forest, "LOCAL_ROWS", local)
    grown, ready = whole_tree(rows)
    spark_ml = DecisionTreeClassifier(labelCol="target_late", weightCol="weight", maxDepth=7, minInstancesPerNode=5)
    wanted = spark_ml.fit(ready.repartition(1))
    assert grown.trees[0].depth == 7
    assert described(grown.trees[0]) == described(wanted)
    both = grown.transform(ready).select("order_id", F.col("probability").alias("p"))
    other = wanted.transform(ready).select("order_id", "probability")
    assert both.join(other, "order_id").where("p <> probability").count() == 0
    assert np.allclose(grown.featureImportances.toArray(), wanted.featureImportances.toArray())


def test_many_rows_are_grown_and_do_not_depend_on_the_place(spark, rows, monkeypatch):
    monkeypatch.setattr(modeling, "SPARK_ML_PAIRS", 1000)
    calls = []
    kept = modeling.fit_grown_forest
    monkeypatch.setattr(modeling, "fit_grown_forest", lambda *a, **b: calls.append(1) or kept(*a, **b))
    made = {}
    for local, shuffled in ((10**6, 2**32), (200, 2**32), (800, 1)):
        monkeypatch.setattr(forest, "LOCAL_ROWS", local)
        monkeypatch.setattr(forest, "SHUFFLED_BYTES", shuffled)
        made[local] = modeling.fit_forest(rows, trees=6, depth=6)
    assert len(calls) == 3
    trees = [[described(t) for t in m.stages[-1].trees] for m in made.values()]
    assert trees[0] == trees[1] == trees[2] and len(set(trees[0])) == 6
    assert isinstance(made[200], PipelineModel) and made[200].stages[-1].getNumTrees == 6
    nodes = model_tables.forest_table(spark, made[200])
    assert nodes.where("node = 0 and rows > 0").count() == 6
    # a tree draws about as many rows as there are
    drawn = [t._call_java("rootNode").impurityStats().rawCount() for t in made[200].stages[-1].trees]
    assert all(2700 < d < 3300 for d in drawn) and len(set(drawn)) > 1


def test_as_good_as_the_forest_of_spark_ml(rows, monkeypatch):
    found = {}
    for pairs in (10**9, 1):
        monkeypatch.setattr(modeling, "SPARK_ML_PAIRS", pairs)
        train, test = rows.where("order_id % 4 > 0"), rows.where("order_id % 4 = 0")
        found[pairs] = modeling.evaluate("x", modeling.fit_forest(train, trees=30, depth=6), test).roc_auc
    assert abs(found[1] - found[10**9]) < 0.01 and found[1] > 0.8


def test_number_columns_of_one_value_and_a_rare_category(rows, monkeypatch):
    monkeypatch.setattr(modeling, "SPARK_ML_PAIRS", 1)
    odd = rows.withColumns({"a": F.lit(None).cast("double"), "b": F.lit(3), "c": F.when(F.col("order_id") == 7, "rare").otherwise("often")})
    model = modeling.fit_forest(odd, trees=3, depth=3, seed=-5)
    assert modeling.score_orders(odd, model, ["a", "b", "c"]).where("probability_late is not null").count() == 3000


def test_deeper_trees_take_no_more_jobs(spark, rows, monkeypatch):
    monkeypatch.setattr(modeling, "SPARK_ML_PAIRS", 1)
    context, jobs = spark.sparkContext, {}
    for depth in (2, 10):
        context.setJobGroup(f"forest-{depth}", "a forest")
        assert max(t.depth for t in modeling.fit_forest(rows, trees=3, depth=depth).stages[-1].trees) == depth
        jobs[depth] = len(context.statusTracker().getJobIdsForGroup(f"forest-{depth}"))
    context.setJobGroup("", "")
    assert 0 < jobs[10] <= jobs[2] + 3  # Spark ML takes one or more for each level
