"""A level of a forest must not cost more the deeper it lies."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier

from parcelight.plans import modeling


def test_rows_keep_their_nodes_and_the_trees_stay_the_same(spark):
    made = [(i, float(i * 37 % 101), float(i * 53 % 89), "xyz"[i % 3], int(i * 37 % 101 + i * 53 % 89 > 95)) for i in range(500)]
    rows = spark.createDataFrame(made, "order_id int, a double, b double, c string, target_late int").repartition(2).checkpoint()
    forest = modeling.fit_forest(rows, trees=4, depth=5).stages[-1]
    assert forest.getCacheNodeIds()
    plain = RandomForestClassifier(
        labelCol="target_late", weightCol="weight", numTrees=4, maxDepth=5, minInstancesPerNode=5,
        featureSubsetStrategy="sqrt", seed=42,
    )
    stages = [*modeling.preprocessing(["a", "b"], ["c"]), plain]
    walked = Pipeline(stages=stages).fit(modeling.with_balanced_weight(rows)).stages[-1]
    trees = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.trees]
    assert trees(forest) == trees(walked)
    assert max(t.depth for t in forest.trees) > 2
