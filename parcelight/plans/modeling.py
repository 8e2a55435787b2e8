"""Late-delivery models: feature frames, training, evaluation, scoring."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.functions.dates import weekday_from_label, weekday_number
from parcelight.functions.numbers import round_half_up
from parcelight.operators.forest import fit_grown_forest
from parcelight.operators.history import seller_hist_late_rate
from parcelight.operators.orders import (
    PURCHASED,
    delivered_orders,
    order_features,
    payment_features,
)
from parcelight.operators.quality import split_by_kind
from parcelight.operators.scaling import ExactScaler, ModeFiller
from parcelight.operators.statistics import classification_report, roc_auc, threshold_scores
from parcelight.plans.model_tables import ranked_importances
from parcelight.session import cut_lineage

# Names of the target, of the columns that are no features, and of
# the metadata's keys (``model_metadata``).
TARGET = "target_late"
NOT_FEATURES = ("order_id", TARGET, PURCHASED, "position", "part", "weight")

# Pairs of a row and a tree up to which Spark ML grows a forest.
SPARK_ML_PAIRS = 10_000_000

# Columns of the two feature frames, in output order.
MODEL_COLUMNS = (
    "order_id", "target_late", "n_items", "total_price", "total_freight",
    "freight_to_price_ratio", "payment_installments", "payment_type", "promised_days",
    "purchase_weekday", "purchase_month", "cross_state", "product_category",
    "seller_hist_late_rate",
)
LIGHT_COLUMNS = tuple(c for c in MODEL_COLUMNS if not c.startswith("payment_"))


# ---- feature frames ----------------------------------------------------------


def model_dataset(orders, items, products, sellers, customers, payments) -> DataFrame:
    """Model features of each delivered order, plus its purchase time.

    The time stays in the frame because rows have no order of their own.
    """
    features = order_features(orders, items, products, sellers, customers)
    paid = payment_features(features, payments)
    history = seller_hist_late_rate(orders, items)
    return (
        paid.join(history, "order_id", "left")
        .na.fill({"seller_hist_late_rate": 0.0})
        .select(*MODEL_COLUMNS, PURCHASED)
    )


def global_late_rate(mart: DataFrame) -> DataFrame:
    """Late share over a mart, as a frame of one row and one column."""
    return mart.agg(F.avg("is_late").alias("global_late_rate"))


def with_global_rate(df: DataFrame, mart: DataFrame, name: str = "seller_hist_late_rate") -> DataFrame:
    return df.withColumn(name, global_late_rate(mart).scalar())


def light_model_dataset(mart: DataFrame) -> DataFrame:
    """Smaller feature frame; the late share of all orders, delivered or not,
    stands in for the seller history."""
    ts = F.col(PURCHASED)
    delivered = delivered_orders(with_global_rate(mart, mart))
    return delivered.withColumns(
        {
            TARGET: F.col("is_late"),
            "purchase_weekday": weekday_number(ts),
            "purchase_month": F.month(ts),
        }
    ).select(*LIGHT_COLUMNS, PURCHASED)


def what_if_features(scenarios: DataFrame, delivered_mart: DataFrame) -> DataFrame:
    """Feature rows for scenarios entered by hand.

    The ratio is that of the totals, the weekday a label, the state question
    Yes or No, and the seller rate that of all delivered orders.
    """
    ratio = F.when(
        F.col("total_price") > 0, round_half_up(F.col("total_freight") / F.col("total_price"), 4)
    ).otherwise(F.lit(0.0))
    prepared = scenarios.withColumns(
        {
            "freight_to_price_ratio": ratio,
            "purchase_weekday": weekday_from_label(F.col("weekday")),
            "purchase_month": F.col("month"),
            "cross_state": F.when(F.col("cross_state_answer") == "Yes", 1).otherwise(0),
        }
    )
    return with_global_rate(prepared, delivered_mart).drop("weekday", "month", "cross_state_answer")


# ---- training ----------------------------------------------------------------


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    return split_by_kind(df, leave_out=NOT_FEATURES)


def preprocessing(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Stages: exact median and most-frequent filling, scaling by population deviation, one-hot.

    A category not seen in training becomes all zeros.
    """
    stages: list = [ModeFiller(categorical, [f"{c}__f" for c in categorical])] if categorical else []
    stages.append(ExactScaler(numeric, [f"{c}__s" for c in numeric]))
    if categorical:
        stages += [
            StringIndexer(
                inputCols=[f"{c}__f" for c in categorical],
                outputCols=[f"{c}__x" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=[f"{c}__x" for c in categorical],
                outputCols=[f"{c}__h" for c in categorical],
                dropLast=True,
            ),
        ]
    stages.append(
        VectorAssembler(
            inputCols=[f"{c}__s" for c in numeric] + [f"{c}__h" for c in categorical], outputCol="features"
        )
    )
    return stages


def balanced_weights(df: DataFrame, target: str = TARGET) -> tuple[int, float, float]:
    """Rows, and the weights of an on-time and of a late one."""
    counts = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(target) == 1).alias("late"))
    ).first()[0]
    late, on_time = max(counts["late"], 1), max(counts["n"] - counts["late"], 1)
    return counts["n"], counts["n"] / (2.0 * on_time), counts["n"] / (2.0 * late)


def with_weight(df: DataFrame, on_time: float, late: float, target: str = TARGET) -> DataFrame:
    return df.withColumn("weight", F.when(F.col(target) == 1, late).otherwise(on_time))


def with_balanced_weight(df: DataFrame, target: str = TARGET) -> DataFrame:
    _, on_time, late = balanced_weights(df, target)
    return with_weight(df, on_time, late, target)


def fit_logistic(train: DataFrame, max_iter: int = 1000, c: float = 1.0) -> PipelineModel:
    """L2 logistic regression.  Spark minimises the mean loss, so the inverse
    strength ``c`` of a summed loss becomes 1 / (c * rows)."""
    numeric, categorical = feature_columns(train)
    rows = max(train.count(), 1)
    classifier = LogisticRegression(
        labelCol=TARGET, maxIter=max_iter, regParam=1.0 / (c * rows),
        elasticNetParam=0.0, standardization=False,
    )
    return Pipeline(stages=[*preprocessing(numeric, categorical), classifier]).fit(train)


def fit_forest(
    train: DataFrame, trees: int = 300, depth: int = 15, min_leaf: int = 5, seed: int = 42
) -> PipelineModel:
    """Random forest with balanced class weights.

    Up to ``SPARK_ML_PAIRS`` pairs of a row and a tree, Spark ML grows it; each row
    keeps the node it has reached in every tree, so a level costs the same however
    deep it lies.  Beyond that, where Spark ML stores a draw and a node for each pair
    and shuffles all nodes' counts of every task, ``operators/forest.py`` grows it by
    the same rules, with draws and columns from streams of its own.
    """
    numeric, categorical = feature_columns(train)
    rows, on_time, late = balanced_weights(train)
    weighted = with_weight(train, on_time, late)
    classifier = RandomForestClassifier(
        labelCol=TARGET, weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True,
    )
    stages = preprocessing(numeric, categorical)
    if rows * trees <= SPARK_ML_PAIRS:
        return Pipeline(stages=[*stages, classifier]).fit(weighted)
    prepared = Pipeline(stages=stages).fit(weighted)
    indexer = next((s for s in prepared.stages if isinstance(s, StringIndexerModel)), None)
    labels = {f"{c}__x": len(found) for c, found in zip(categorical, indexer.labelsArray, strict=True)} if indexer else {}
    forest = fit_grown_forest(
        prepared.transform(weighted), [f"{c}__s" for c in numeric], labels, classifier, (on_time, late), rows
    )
    return PipelineModel(stages=[*prepared.stages, forest])


def fit_light_forest(train: DataFrame, trees: int = 200, depth: int = 12) -> PipelineModel:
    return fit_forest(train, trees=trees, depth=depth)


# ---- scoring and evaluation --------------------------------------------------


def require_features(df: DataFrame, needed: Sequence[str]) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise KeyError(f"missing features {missing}; needed are {list(needed)}")


def score_orders(
    df: DataFrame, model: PipelineModel, needed: Sequence[str], threshold: float = 0.5
) -> DataFrame:
    """Input rows with the late probability and the decision; works on a
    streaming frame as well."""
    require_features(df, needed)
    scored = model.transform(df).withColumn("__p", vector_to_array("probability")[1])
    decided = threshold_scores(scored, "__p", threshold)
    return decided.select(*df.columns, "late_probability", "predicted_late", "__p").withColumnRenamed(
        "__p", "probability_late"
    )


@dataclass
class Evaluation:
    name: str
    roc_auc: float
    f1: float
    report: list[dict] = field(default_factory=list)


def evaluate(name: str, model: PipelineModel, test: DataFrame) -> Evaluation:
    numeric, categorical = feature_columns(test)
    scored = cut_lineage(
        score_orders(test, model, numeric + categorical).select(
            TARGET, "probability_late", "predicted_late"
        )
    )
    auc = roc_auc(scored, "probability_late", TARGET).first()["roc_auc"]
    lines = [r.asDict() for r in classification_report(scored, TARGET, "predicted_late").collect()]
    f1 = next(r["f1"] for r in lines if r["line"] == "late")
    return Evaluation(name, round(auc, 4) if auc is not None else float("nan"), round(f1, 4), lines)


def better_model(first: Evaluation, second: Evaluation) -> Evaluation:
    """Higher rounded AUC wins, the first one on a tie."""
    return first if first.roc_auc >= second.roc_auc else second


def expanded_names(model: PipelineModel, sample: DataFrame) -> list[str]:
    """Names of the feature vector's slots; one-hot slots carry their category."""
    attrs = model.transform(sample.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    numeric, _ = feature_columns(sample)
    return [
        numeric[i] if i < len(numeric) else name.replace("__h_", "_") for i, name in slots
    ]


def top_importances(model: PipelineModel, sample: DataFrame, n: int = 10) -> list[dict]:
    """The model's own vector of importances; its length is the number of features."""
    values = model.stages[-1].featureImportances.toArray()
    named = sorted(zip(expanded_names(model, sample), values), key=lambda x: (-x[1], x[0]))[:n]
    return [
        {"rank": i + 1, "feature": name, "importance": round(float(v), 4)}
        for i, (name, v) in enumerate(named)
    ]


def feature_importances(spark: SparkSession, top: list[dict]) -> DataFrame:
    """Chart rows: names cut to 45 characters and a flag above 0.03."""
    return ranked_importances(spark.createDataFrame(top, "rank int, feature string, importance double"), len(top))


def train_and_select(
    train: DataFrame, test: DataFrame, trees: int = 300, depth: int = 15, max_iter: int = 1000
) -> tuple[PipelineModel, dict]:
    """Fit both kinds of model, keep the better one, and describe the run."""
    logistic = fit_logistic(train, max_iter)
    forest = fit_forest(train, trees, depth)
    results = (evaluate("LogisticRegression", logistic, test), evaluate("RandomForest", forest, test))
    best = better_model(*results)
    metadata = model_metadata(
        best,
        results,
        {"train": _balance(train), "test": _balance(test)},
        feature_columns(train),
        expanded_names(forest, train),
        top_importances(forest, train),
        {
            "LogisticRegression": {"max_iter": max_iter},
            "RandomForest": {"trees": trees, "depth": depth, "min_leaf": 5, "class_weight": "balanced", "seed": 42},
        },
    )
    return (logistic if best is results[0] else forest), metadata


def _balance(df: DataFrame) -> dict[str, int]:
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(TARGET) == 1).alias("late")
    ).first()
    return {"rows": row["rows"], "late": row["late"], "on_time": row["rows"] - row["late"]}


# ---- persistence -------------------------------------------------------------


def model_metadata(
    best: Evaluation,
    evaluations: Sequence[Evaluation],
    balance: Mapping[str, Mapping[str, int]],
    columns: tuple[Sequence[str], Sequence[str]],
    all_features: Sequence[str],
    top: Sequence[dict],
    parameters: Mapping[str, Mapping],
) -> dict:
    return {
        "best_model": best.name,
        "metrics": {e.name: {"roc_auc": e.roc_auc, "f1": e.f1} for e in evaluations},
        "reports": {e.name: asdict(e)["report"] for e in evaluations},
        "balance": {k: dict(v) for k, v in balance.items()},
        "numeric_features": list(columns[0]),
        "categorical_features": list(columns[1]),
        "all_transformed_features": list(all_features),
        "top_features": list(top),
        "parameters": {k: dict(v) for k, v in parameters.items()},
    }


_LOADED: dict[str, tuple[str, PipelineModel]] = {}


def save_model(spark: SparkSession, model: PipelineModel, metadata: dict, folder: str) -> None:
    _LOADED.pop(folder, None)
    model.write().overwrite().save(f"{folder}/model")
    text = spark.createDataFrame([(json.dumps(metadata),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def load_model(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict]:
    """Model and metadata; a model is kept as long as its metadata stays the same."""
    text = spark.read.text(f"{folder}/metadata").first()["value"]
    if folder not in _LOADED or _LOADED[folder][0] != text:
        _LOADED[folder] = (text, PipelineModel.load(f"{folder}/model"))
    return _LOADED[folder][1], json.loads(text)
