import pytest
from pyspark.sql import functions as F

from parcelight.operators.history import time_split
from parcelight.operators.orders import PURCHASED, order_mart
from parcelight.plans import modeling
from parcelight.streaming.scoring import score_arrivals


@pytest.fixture(scope="module")
def parts(spark, inputs):
    i = inputs
    frame = modeling.model_dataset(
        i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_payments
    )
    split = time_split(frame, [PURCHASED, "order_id"]).checkpoint()
    cut = lambda name: split.where(F.col("part") == name).drop("part", "position")
    return cut("train"), cut("test")


@pytest.fixture(scope="module")
def logistic(parts):
    return modeling.fit_logistic(parts[0])


def test_dataset_columns(parts):
    assert parts[0].columns == [*modeling.MODEL_COLUMNS, PURCHASED]
    numeric, categorical = modeling.feature_columns(parts[0])
    assert len(numeric) == 10 and categorical == ["payment_type", "product_category"]


def test_logistic_learns_the_signal(parts, logistic):
    result = modeling.evaluate("LogisticRegression", logistic, parts[1])
    assert result.roc_auc > 0.6
    assert {line["line"] for line in result.report} == {"on_time", "late", "accuracy", "macro avg", "weighted avg"}


def test_forest_and_importances(spark, parts):
    model = modeling.fit_forest(parts[0], trees=5, depth=4)
    result = modeling.evaluate("RandomForest", model, parts[1])
    assert result.roc_auc > 0.6
    names = modeling.expanded_names(model, parts[0])
    assert len(names) == len(set(names)) == model.stages[-1].featureImportances.size
    assert "payment_type_boleto" in names and names[:2] == ["n_items", "total_price"]
    top = modeling.top_importances(model, parts[0])
    assert top[0]["feature"] == "promised_days" and [t["rank"] for t in top] == list(range(1, 11))
    chart = modeling.feature_importances(spark, top).collect()
    assert chart[0]["highlight"] is True and max(len(r["feature"]) for r in chart) <= 45


def test_unseen_category_and_null_values_score(spark, parts, logistic):
    needed = sum(modeling.feature_columns(parts[0]), [])
    odd = parts[1].limit(3).withColumns(
        {"product_category": F.lit("never seen"), "payment_type": F.lit(None).cast("string"), "total_price": F.lit(None).cast("double")}
    )
    scored = modeling.score_orders(odd, logistic, needed).collect()
    assert len(scored) == 3 and all(0 <= r["late_probability"] <= 1 for r in scored)
    assert all(r["predicted_late"] == int(r["probability_late"] >= 0.5) for r in scored)


def test_a_common_category_may_hold_quotes(spark):
    odd = "it's a \\ name"
    rows = [(i, i % 2, float(i % 7), odd if i % 3 else None) for i in range(60)]
    frame = spark.createDataFrame(rows, "order_id long, target_late int, x double, c string")
    model = modeling.fit_logistic(frame, max_iter=5)
    filled = model.stages[0].transform(frame).select("c__f").distinct().collect()
    assert [r[0] for r in filled] == [odd]


def test_missing_feature_is_an_error(parts, logistic):
    needed = sum(modeling.feature_columns(parts[0]), [])
    with pytest.raises(KeyError, match="n_items"):
        modeling.score_orders(parts[1].drop("n_items"), logistic, needed)


def test_save_load_and_metadata(spark, parts, logistic, tmp_path):
    train, test = parts
    columns = modeling.feature_columns(train)
    result = modeling.evaluate("LogisticRegression", logistic, test)
    other = modeling.Evaluation("RandomForest", result.roc_auc, 0.0)
    assert modeling.better_model(result, other) is result
    metadata = modeling.model_metadata(
        result, [result, other], {"train": {"late": 1, "on_time": 2}}, columns,
        modeling.expanded_names(logistic, train), [], {"LogisticRegression": {"max_iter": 1000}},
    )
    folder = str(tmp_path / "late")
    modeling.save_model(spark, logistic, metadata, folder)
    model, loaded = modeling.load_model(spark, folder)
    assert loaded["best_model"] == "LogisticRegression"
    assert modeling.load_model(spark, folder)[0] is model
    needed = loaded["numeric_features"] + loaded["categorical_features"]
    score = lambda m: {r["order_id"]: r["probability_late"] for r in modeling.score_orders(test, m, needed).collect()}
    assert score(model) == score(logistic)


def test_the_better_model_is_kept(spark, parts):
    train, test = parts
    model, metadata = modeling.train_and_select(train, test, trees=3, depth=3, max_iter=50)
    scores = {name: m["roc_auc"] for name, m in metadata["metrics"].items()}
    assert metadata["best_model"] == max(scores, key=scores.get)
    assert metadata["balance"]["train"]["rows"] == train.count()
    assert sum(metadata["balance"]["test"][k] for k in ("late", "on_time")) == test.count()
    assert len(metadata["top_features"]) == 10
    needed = metadata["numeric_features"] + metadata["categorical_features"]
    assert modeling.score_orders(test, model, needed).count() == test.count()


def test_stream_scores_like_batch(spark, parts, logistic, tmp_path):
    test = parts[1]
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    test.repartition(3).write.parquet(source)
    needed = sum(modeling.feature_columns(test), [])
    run = lambda: score_arrivals(spark, source, test.schema, logistic, needed, target, progress, files_per_batch=1).awaitTermination()
    run()
    run()  # nothing new: nothing scored twice
    streamed = {r["order_id"]: r["late_probability"] for r in spark.read.parquet(target).collect()}
    batch = modeling.score_orders(test, logistic, needed).collect()
    assert spark.read.parquet(target).count() == len(batch)
    assert streamed == {r["order_id"]: r["late_probability"] for r in batch}


def test_light_model(inputs):
    i = inputs
    mart = order_mart(i.shop_orders, i.shop_items, i.shop_products, i.shop_sellers, i.shop_customers, i.shop_reviews)
    frame = modeling.light_model_dataset(mart).checkpoint()
    assert set(frame.columns) == {*modeling.LIGHT_COLUMNS, PURCHASED}
    model = modeling.fit_light_forest(frame, trees=3, depth=3)
    assert modeling.top_importances(model, frame)[0]["feature"] == "promised_days"
