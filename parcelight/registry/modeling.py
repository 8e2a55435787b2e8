"""Registered queries for imputation, metrics, training and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.functions.numbers import round_half_up
from parcelight.functions.text import late_label
from parcelight.operators import history, orders
from parcelight.operators import statistics as stats
from parcelight.operators.orders import PURCHASED
from parcelight.plans import dashboard, model_tables, modeling
from parcelight.registry.orders import (
    FEATURES_SQL,
    MART_SQL,
    MART_VIEWS,
    PAID_SQL,
    STAR,
    dataset,
    features,
    mart,
)
from parcelight.registry.spec import Spec, rounded
from parcelight.session import cut_lineage, hash_joins, shared_path, without_old_shuffles
from parcelight.sources.fixtures import Inputs

_NUMERIC = ("n_items", "total_price", "total_freight", "freight_to_price_ratio",
            "payment_installments", "promised_days")
_TEXT = ("payment_type", "product_category")
_KNOWN = "product_category < 'Brand#44'"
_KINDS = ("payment_type", "product_category")


def unfilled(i: Inputs) -> DataFrame:
    """Order features with the payment columns still null where there is no payment."""
    return orders.payment_features(features(i), i.shop_payments, fill=False)


_UNFILLED_SQL = f""", {FEATURES_SQL}, {PAID_SQL},
unfilled as (select f.*, payment_installments, payment_type
    from features f left join paid using (order_id))
"""


def _mode_sql(column: str) -> str:
    return (
        f"coalesce({column}, (select {column} from unfilled where {column} is not null"
        f" group by 1 order by count(*) desc, 1 limit 1)) as {column}"
    )


def _standardized(i: Inputs) -> DataFrame:
    columns = ("total_price", "total_freight", "promised_days")
    scaled = stats.standardize(features(i).select("order_id", *columns), columns)
    return scaled.withColumns({c: round_half_up(F.col(c), 6) for c in columns})


def _what_if(i: Inputs) -> DataFrame:
    delivered = dashboard.delivered_only(mart(i))
    scenarios = delivered.select(
        "order_id", "n_items", "total_price", "total_freight", "promised_days",
        F.date_format(PURCHASED, "E").alias("weekday"), F.month(PURCHASED).alias("month"),
        F.when(F.col("cross_state") == 1, "Yes").otherwise("No").alias("cross_state_answer"),
        "product_category",
    )
    return modeling.what_if_features(scenarios, delivered)


def _scored(i: Inputs) -> DataFrame:
    return i.score_table.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


_PREDICTED_SQL = ", predicted as (select *, cast(score >= 0.5 as int) as predicted from score_table)\n"

_REPORT_SQL = _PREDICTED_SQL + """, cells as (select
    count(*) filter (label = 0 and predicted = 0)::double as n00,
    count(*) filter (label = 0 and predicted = 1)::double as n01,
    count(*) filter (label = 1 and predicted = 0)::double as n10,
    count(*) filter (label = 1 and predicted = 1)::double as n11 from predicted),
classes as (
    select 'on_time' as line, n00 / (n00 + n10) as precision, n00 / (n00 + n01) as recall, n00 + n01 as support from cells
    union all select 'late', n11 / (n01 + n11), n11 / (n10 + n11), n10 + n11 from cells),
scored as (select line, precision, recall, 2 * precision * recall / (precision + recall) as f1, support from classes),
total as (select sum(support) as n from scored),
lines as (
    select * from scored
    union all select 'accuracy', (n00 + n11) / n, (n00 + n11) / n, (n00 + n11) / n, n from cells, total
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from scored
    union all select 'weighted avg', sum(precision * support) / sum(support),
        sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) from scored)
select line, """ + ", ".join(f"{rounded(c, 9)} as {c}" for c in ("precision", "recall", "f1")) + """,
    cast(support as bigint) as support from lines"""


def _report(i: Inputs) -> DataFrame:
    report = stats.classification_report(_scored(i), "label", "predicted")
    return report.withColumns({c: round_half_up(F.col(c), 9) for c in ("precision", "recall", "f1")})


# ---- training ----------------------------------------------------------------


def _parts(frame: DataFrame, order_by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the frame is read many times, so it is cut off here, and what it shuffled goes."""
    with without_old_shuffles(frame.sparkSession):
        rows = cut_lineage(frame.select("*"))  # a plan made in here
    early = history.is_train(rows, order_by)
    return rows.where(early), rows.where(~early)


def _model_parts(i: Inputs) -> tuple[DataFrame, DataFrame]:
    with hash_joins(i.spark):
        return _parts(dataset(i), [PURCHASED, "order_id"])


def _report_frame(i: Inputs, result: modeling.Evaluation, train: DataFrame, test: DataFrame) -> DataFrame:
    late = next(line for line in result.report if line["line"] == "late")
    row = (result.name, result.roc_auc, result.f1, late["precision"], late["recall"], train.count(), test.count())
    return i.spark.createDataFrame(
        [row],
        "model string, roc_auc double, f1 double, precision_late double, recall_late double,"
        " train_rows long, test_rows long",
    )


_SAVED: dict[tuple[str, str, str], str] = {}


def _fitted(i: Inputs, name: str, fit, train: DataFrame, digest: str | None = None):
    """A model fitted now, saved to the shared folder with its metadata and read again."""
    folder = shared_path(i.spark, name)
    numeric, categorical = modeling.feature_columns(train)
    metadata = {"best_model": name, "numeric_features": numeric, "categorical_features": categorical}
    modeling.save_model(i.spark, fit(train), metadata, folder)
    _SAVED[(i.spark.sparkContext.applicationId, name, digest or _digest(train))] = folder
    return modeling.load_model(i.spark, folder)


def _digest(train: DataFrame) -> str:
    """Tells training rows apart, whatever their order."""
    row = train.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*train.columns).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"


def _saved(i: Inputs, name: str, fit, train: DataFrame):
    """The model of exactly these training rows, fitted only if this application has not done so."""
    digest = _digest(train)
    folder = _SAVED.get((i.spark.sparkContext.applicationId, name, digest))
    return modeling.load_model(i.spark, folder) if folder else _fitted(i, name, fit, train, digest)


def _train_logistic(i: Inputs) -> DataFrame:
    train, test = _model_parts(i)
    model, _ = _fitted(i, "LogisticRegression", modeling.fit_logistic, train)
    return _report_frame(i, modeling.evaluate("LogisticRegression", model, test), train, test)


def _train_forest(i: Inputs) -> DataFrame:
    train, test = _model_parts(i)
    model, _ = _fitted(i, "RandomForest", modeling.fit_forest, train)
    return _report_frame(i, modeling.evaluate("RandomForest", model, test), train, test)


def _train_light(i: Inputs) -> DataFrame:
    train, test = _parts(modeling.light_model_dataset(mart(i)), ["order_id"])
    model, _ = _fitted(i, "LightForest", modeling.fit_light_forest, train)
    return _report_frame(i, modeling.evaluate("LightForest", model, test), train, test)


def _importances(i: Inputs) -> DataFrame:
    """Importances summed from the nodes of the forest."""
    train, _ = _model_parts(i)
    model, _ = _saved(i, "RandomForest", modeling.fit_forest, train)
    nodes = model_tables.forest_table(i.spark, model)
    return model_tables.ranked_importances(model_tables.forest_importances(nodes, modeling.expanded_names(model, train)))


def _importance_chart(i: Inputs) -> DataFrame:
    """Shares of the item prices by product, a long list of names and shares, ranked and cut like importances."""
    lines = i.lineitem.join(i.part.where("p_size <= 10"), F.col("l_partkey") == F.col("p_partkey"))
    whole = lines.agg(F.sum("l_quantity")).scalar()
    listed = lines.groupBy(
        F.concat_ws(" ", "p_type", "p_brand", F.lit("as sold by all sellers in one order line")).alias("feature")
    ).agg(F.sum("l_quantity").alias("q"))
    return model_tables.ranked_importances(listed.select("feature", (F.col("q") / whole).alias("importance")))


_CHART_SQL = f"""with listed as (
    select p_type || ' ' || p_brand || ' as sold by all sellers in one order line' as feature,
        sum(l_quantity) / (select sum(l_quantity) from lineitem join part on l_partkey = p_partkey where p_size <= 10) as importance
    from lineitem join part on l_partkey = p_partkey where p_size <= 10 group by 1)
select cast(row_number() over (order by importance desc, feature) as int) as rank, feature[:45] as feature,
    {rounded("importance", 4)} as importance, {rounded("importance", 4)} > 0.03 as highlight
from listed order by rank limit 10"""


def _preprocessed(i: Inputs) -> DataFrame:
    """The feature vector as training makes it, from a fitted pipeline that was saved and loaded."""
    rows = cut_lineage(unfilled(i).select("order_id", *_NUMERIC, *_KINDS))  # read by each stage's fit and at the end
    seen = rows.where(_KNOWN)
    path = shared_path(i.spark, "preprocessing")
    Pipeline(stages=modeling.preprocessing(list(_NUMERIC), list(_KINDS))).fit(seen).write().save(path)
    made = PipelineModel.load(path).transform(rows).withColumn("__v", vector_to_array("features"))
    slot = lambda c: (F.array_position(vector_to_array(f"{c}__h"), F.lit(1.0)) - 1).cast("int").alias(f"{c}_slot")
    return made.select(
        "order_id", *[round_half_up(F.col("__v")[n], 6).alias(c) for n, c in enumerate(_NUMERIC)], *[slot(c) for c in _KINDS]
    )


def _decisions(df: DataFrame, model, metadata: dict) -> DataFrame:
    needed = metadata["numeric_features"] + metadata["categorical_features"]
    scored = modeling.score_orders(df, model, needed)
    return scored.select("order_id", "late_probability", "predicted_late", late_label(F.col("predicted_late")).alias("label"))


def _score_orders(i: Inputs) -> DataFrame:
    """Every order, scored by the weight table of the model of the early ones."""
    train, test = _model_parts(i)
    model, _ = _saved(i, "LogisticRegression", modeling.fit_logistic, train)
    scored = model_tables.score_with_table(train.unionByName(test), model_tables.logistic_table(i.spark, model))
    return scored.select("order_id", "late_probability", "predicted_late", late_label(F.col("predicted_late")).alias("label"))


def _score_what_if(i: Inputs) -> DataFrame:
    """Scenarios scored by the saved light model."""
    train, _ = _parts(modeling.light_model_dataset(mart(i)), ["order_id"])
    return _decisions(_what_if(i), *_saved(i, "LightForest", modeling.fit_light_forest, train))


# ---- parts of the models that SQL can say --------------------------------------


def _one_hot(i: Inputs) -> DataFrame:
    """The one-hot slot of each category, -1 for a category that the fit did not see."""
    rows = cut_lineage(unfilled(i).select("order_id", "total_price", *_KINDS))  # as above
    seen = rows.where(_KNOWN)
    fitted = Pipeline(stages=modeling.preprocessing(["total_price"], list(_KINDS))).fit(seen)
    place = lambda c: (F.array_position(vector_to_array(f"{c}__h"), F.lit(1.0)) - 1).cast("int").alias(f"{c}_slot")
    return fitted.transform(rows).select("order_id", *[place(c) for c in _KINDS])


def _slots_sql(column: str) -> str:
    return f"""{column}_mode as (select {column} as common from seen where {column} is not null
    group by 1 order by count(*) desc, 1 limit 1),
{column}_slots as (select v, cast(row_number() over (order by v) - 1 as int) as slot from (
    select distinct coalesce({column}, (select common from {column}_mode)) as v from seen))"""


_SCORES = {"score": "score", "reversed": "1 - score", "squared": "score * score"}
_PAIRS = (("score", "reversed"), ("reversed", "score"), ("score", "squared"), ("squared", "score"))


def _choice(i: Inputs) -> DataFrame:
    """The better of two scores by area under the curve, the first on a tie."""
    rated = {}
    for name, rule in _SCORES.items():
        area = stats.roc_auc(i.score_table.withColumn("s", F.expr(rule)), "s", "label").first()["roc_auc"]
        rated[name] = modeling.Evaluation(name, round(area, 4), 0.0)
    rows = [(a, b, best.name, best.roc_auc) for a, b in _PAIRS for best in [modeling.better_model(rated[a], rated[b])]]
    return i.spark.createDataFrame(rows, "first string, second string, best string, roc_auc double")


def _area_sql(name: str, rule: str) -> str:
    return f"""select '{name}' as name, {rounded("(rs - n_pos * (n_pos + 1) / 2.0::double) / (n_pos::double * n_neg)", 4)} as area from (
        select count(*) filter (label = 1) as n_pos, count(*) filter (label = 0) as n_neg, sum(r) filter (label = 1) as rs
        from (select label, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double as r
            from (select label, {rule} as s from score_table)))"""


_CHOICE_SQL = (
    ", areas as (" + " union all ".join(_area_sql(n, r) for n, r in _SCORES.items()) + "), pairs(first, second) as (values "
    + ", ".join(str(pair) for pair in _PAIRS)
    + """) select first, second, case when a.area >= b.area then first else second end as best,
    greatest(a.area, b.area) as roc_auc from pairs join areas a on a.name = first join areas b on b.name = second"""
)


SPECS: dict[str, Spec] = {
    "impute_median": Spec(
        lambda i: stats.fill_medians(unfilled(i), _NUMERIC).select("order_id", *_NUMERIC),
        STAR + " shop_payments",
        _UNFILLED_SQL
        + "select order_id, "
        + ", ".join(f"coalesce({c}, (select median({c}) from unfilled))::double as {c}" for c in _NUMERIC)
        + " from unfilled",
    ),
    "impute_mode": Spec(
        lambda i: stats.fill_modes(unfilled(i), _TEXT).select("order_id", *_TEXT),
        STAR + " shop_payments",
        _UNFILLED_SQL + "select order_id, " + ", ".join(_mode_sql(c) for c in _TEXT) + " from unfilled",
    ),
    "standardize": Spec(
        _standardized,
        STAR,
        f", {FEATURES_SQL}, f as (select avg(total_price) as m1, stddev_pop(total_price) as s1,"
        " avg(total_freight) as m2, stddev_pop(total_freight) as s2,"
        " avg(promised_days) as m3, stddev_pop(promised_days) as s3 from features)\n"
        f"select order_id, {rounded('(total_price - m1) / s1', 6)} as total_price,"
        f" {rounded('(total_freight - m2) / s2', 6)} as total_freight,"
        f" {rounded('(promised_days - m3) / s3', 6)} as promised_days from features, f",
    ),
    "class_weights": Spec(
        lambda i: stats.class_weights(features(i), "target_late"),
        STAR,
        f""", {FEATURES_SQL}, c as (select target_late as label, count(*) as n from features group by 1)
        select label, n, (select sum(n) from c)::double / ((select count(*) from c) * n) as weight from c""",
    ),
    "what_if_features": Spec(
        _what_if,
        MART_VIEWS,
        f""", {MART_SQL}, delivered as (select * from mart where order_status = 'delivered')
        select order_id, n_items, total_price, total_freight, promised_days, product_category,
            case when total_price > 0 then {rounded("total_freight / total_price", 4)} else 0 end
                as freight_to_price_ratio,
            cast(isodow(order_purchase_timestamp) - 1 as int) as purchase_weekday,
            cast(month(order_purchase_timestamp) as int) as purchase_month, cross_state,
            (select avg(is_late) from delivered) as seller_hist_late_rate from delivered""",
    ),
    "auc_rank": Spec(
        lambda i: stats.roc_auc(i.score_table, "score", "label").withColumn(
            "roc_auc", round_half_up(F.col("roc_auc"), 9)
        ),
        "score_table",
        """, ranked as (select label, rank() over (order by score)
                + (count(*) over (partition by score) - 1) / 2.0::double as r from score_table),
        s as (select count(*) filter (label = 1) as n_pos, count(*) filter (label = 0) as n_neg,
            sum(r) filter (label = 1) as rs from ranked)
        select n_pos, n_neg, """
        + rounded("(rs - n_pos * (n_pos + 1) / 2.0::double) / (n_pos::double * n_neg)", 9)
        + " as roc_auc from s",
    ),
    "confusion_matrix": Spec(
        lambda i: stats.confusion_matrix(_scored(i), "label", "predicted"),
        "score_table",
        _PREDICTED_SQL
        + """select t as label, p as predicted, (select count(*) from predicted
            where label = t and predicted = p) as n
        from (values (0, 0), (0, 1), (1, 0), (1, 1)) as cells(t, p)""",
    ),
    "classification_report": Spec(_report, "score_table", _REPORT_SQL),
    "threshold_scores": Spec(
        lambda i: stats.threshold_scores(i.score_table, "score").select(
            "order_id", "late_probability", "predicted_late",
            late_label(F.col("predicted_late")).alias("decision"),
        ),
        "score_table",
        f"""select order_id, {rounded("score", 4)} as late_probability,
            cast(score >= 0.5 as int) as predicted_late,
            case when score >= 0.5 then 'LATE' else 'ON TIME' end as decision from score_table""",
    ),
    "one_hot_slots": Spec(
        _one_hot,
        STAR + " shop_payments",
        _UNFILLED_SQL
        + f", seen as (select * from unfilled where {_KNOWN}), "
        + ", ".join(_slots_sql(c) for c in _KINDS)
        + " select order_id, "
        + ", ".join(f"coalesce(s{n}.slot, -1) as {c}_slot" for n, c in enumerate(_KINDS))
        + " from unfilled "
        + " ".join(
            f"left join {c}_slots s{n} on s{n}.v = coalesce({c}, (select common from {c}_mode))" for n, c in enumerate(_KINDS)
        ),
    ),
    "preprocessed_features": Spec(
        _preprocessed,
        STAR + " shop_payments",
        _UNFILLED_SQL
        + f", seen as (select * from unfilled where {_KNOWN}), medians as (select "
        + ", ".join(f"median({c}) as {c}" for c in _NUMERIC)
        + " from seen), filled as (select "
        + ", ".join(f"coalesce(seen.{c}, m.{c})::double as {c}" for c in _NUMERIC)
        + " from seen, medians m), figures as (select "
        + ", ".join(f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in _NUMERIC)
        + " from filled), "
        + ", ".join(_slots_sql(c) for c in _KINDS)
        + " select order_id, "
        + ", ".join(f"{rounded(f'(coalesce(unfilled.{c}, m.{c})::double - {c}_m) / {c}_s', 6)} as {c}" for c in _NUMERIC)
        + ", "
        + ", ".join(f"coalesce(s{n}.slot, -1) as {c}_slot" for n, c in enumerate(_KINDS))
        + " from unfilled cross join medians m cross join figures "
        + " ".join(
            f"left join {c}_slots s{n} on s{n}.v = coalesce(unfilled.{c}, (select common from {c}_mode))" for n, c in enumerate(_KINDS)
        ),
    ),
    "importance_chart": Spec(_importance_chart, sql=_CHART_SQL),
    "model_choice": Spec(_choice, "score_table", _CHOICE_SQL),
    "train_logistic": Spec(_train_logistic),
    "train_forest": Spec(_train_forest),
    "train_light_forest": Spec(_train_light),
    "feature_importances": Spec(_importances),
    "score_orders": Spec(_score_orders),
    "score_what_if": Spec(_score_what_if),
}
