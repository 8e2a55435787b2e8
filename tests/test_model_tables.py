import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parcelight.plans import model_tables, modeling
from parcelight.plans.dashboard import delivery_histogram

NUMBERS, KINDS = ["a", "b"], ["c"]


@pytest.fixture(scope="module")
def rows(spark):
    made = [
        (i, float(i % 7) if i % 5 else None, float("nan") if i % 11 == 0 else (i * 37 % 101) / 3, [None, "x", "it's", "z"][i % 4], int((i * 37 % 101) > 60 or i % 7 == 6))
        for i in range(600)
    ]
    return spark.createDataFrame(made, "order_id int, a double, b double, c string, target_late int").checkpoint()


def test_scaler_learns_exact_figures_and_survives_saving(spark, rows, tmp_path):
    fitted = Pipeline(stages=modeling.preprocessing(NUMBERS, KINDS)).fit(rows)
    fitted.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pandas = rows.toPandas()
    filled = pandas[NUMBERS].fillna(pandas[NUMBERS].median())
    want = (filled - filled.mean()) / filled.std(ddof=0)
    for model in (fitted, again):
        got = model.transform(rows).select(vector_to_array("features").alias("v")).toPandas()["v"]
        assert max(abs(v[i] - want.iloc[n, i]) for n, v in enumerate(got) for i in range(2)) < 1e-12
    fills = next(s for s in again.stages if hasattr(s, "fills")).fills()
    assert fills == {"c": min(pandas["c"].value_counts().loc[lambda s: s == s.max()].index)}


def test_scaler_on_constant_and_empty_columns(spark):
    odd = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    got = Pipeline(stages=modeling.preprocessing(["a", "b"], [])).fit(odd).transform(odd)
    assert [r["v"] for r in got.select(vector_to_array("features").alias("v")).collect()] == [[0.0, 0.0], [0.0, 0.0]]


def test_logistic_table_scores_as_the_model_does(spark, rows):
    model = modeling.fit_logistic(rows)
    table = model_tables.logistic_table(spark, model)
    odd = spark.createDataFrame([(1000, None, None, None, 0), (1001, 2.0, 1.0, "never seen", 1)], rows.schema)
    everything = rows.unionByName(odd)
    theirs = model.transform(everything).select("order_id", vector_to_array("probability")[1].alias("p"))
    ours = model_tables.logistic_probability(everything, table)
    assert ours.columns == [*everything.columns, "probability_late"]
    gap = ours.join(theirs, "order_id").agg(F.count(F.lit(1)), F.max(F.abs(F.col("p") - F.col("probability_late")))).first()
    assert gap[0] == 602 and gap[1] < 1e-9


def test_decision_is_on_the_unrounded_half(spark):
    table = spark.createDataFrame(
        [("intercept", None, None, 0.0, None, None, None), ("number", "x", None, 1.0, 0.0, 0.0, 1.0)], model_tables._LOGISTIC
    )
    rows = spark.createDataFrame([(-1e-6,), (0.0,), (1e-6,)], "x double")
    got = model_tables.score_with_table(rows, table).orderBy("x").collect()
    assert [r["late_probability"] for r in got] == [0.5, 0.5, 0.5]
    assert [r["predicted_late"] for r in got] == [0, 1, 1]


def test_forest_table_scores_and_ranks_as_the_model_does(spark, rows):
    model = modeling.fit_forest(rows, trees=7, depth=6)
    nodes = model_tables.forest_table(spark, model).checkpoint()
    made = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    ours = model_tables.forest_probability(made, nodes, depth=6)
    assert ours.agg(F.max(F.abs(F.col("p") - F.col("probability_late")))).first()[0] < 1e-9
    names = modeling.expanded_names(model, rows)
    listed = {r["feature"]: r["importance"] for r in model_tables.forest_importances(nodes, names).collect()}
    theirs = dict(zip(names, model.stages[-1].featureImportances.toArray(), strict=True))
    assert listed.keys() == theirs.keys() and max(abs(listed[k] - theirs[k]) for k in names) < 1e-9
    top = [r["feature"] for r in model_tables.ranked_importances(model_tables.forest_importances(nodes, names)).collect()]
    assert top == [t["feature"] for t in modeling.top_importances(model, rows)]


@pytest.mark.parametrize(("days", "width"), [([0, 29], 1), ([0, 30], 2), ([-400, 2000], 100), ([5], 1), ([], None)])
def test_histogram_has_thirty_bins_at_most(spark, days, width):
    orders = spark.createDataFrame([(d, 0) for d in days], "delivery_days int, is_late int")
    got = delivery_histogram(orders).collect()
    assert {r["width"] for r in got} == ({width} if days else set())
    assert sum(r["orders"] for r in got) == len(days)
    assert all(r["days_from"] % width == 0 for r in got)
