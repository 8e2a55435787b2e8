"""Exact medians, modes, scaling figures and classifier metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.operators.prefix import prior_totals
from parcelight.session import cut_lineage


# ---- imputation and scaling --------------------------------------------------


# Half-width, in shares of the rows, of the range around the middle that is
# looked at closely, and the accuracy of the sketch that finds the range.  One
# task merges the sketches of all others, which takes as long as they are fine;
# an error of 1 / 2,000 keeps the middle inside.
_NEAR_MIDDLE = 0.001
_SKETCH_ACCURACY = 2_000


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median of every column: one row each of ``column_name`` and ``median``.

    A sketch finds a narrow range that holds the middle; only the values in it
    are counted and put in order, across tasks, and the rows below it are just
    counted.  Should the range miss the middle of a column, the whole column is
    taken.  Missing values and NaN are left out.
    """
    numbers = cut_lineage(
        df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    )
    shares = [0.5 - _NEAR_MIDDLE, 0.5 + _NEAR_MIDDLE]
    sketched = numbers.agg(
        *[F.percentile_approx(c, shares, _SKETCH_ACCURACY).alias(c) for c in columns]
    ).first()
    ranges = {c: tuple(sketched[c]) for c in columns if sketched[c] is not None}
    if not ranges:
        return df.sparkSession.createDataFrame([], "column_name string, median double")

    def place(c: str) -> Column:
        low, high = ranges[c]
        return F.struct(
            F.count(c).alias("n"),
            F.count_if(F.col(c) < low).alias("below"),
            F.count_if(F.col(c) <= high).alias("up_to"),
        ).alias(c)

    found = numbers.agg(*[place(c) for c in ranges]).first()
    below = {}
    for c in ranges:
        inside = found[c]["below"] <= (found[c]["n"] - 1) // 2 and found[c]["n"] // 2 < found[c]["up_to"]
        below[c] = found[c]["below"] if inside else 0
        ranges[c] = ranges[c] if inside else (float("-inf"), float("inf"))

    near = numbers.select(*[F.when(F.col(c).between(*r), F.col(c)).alias(c) for c, r in ranges.items()])
    counted = (
        near.unpivot([], list(ranges), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = prior_totals(counted, ["value"], {"earlier": F.col("n")}, ["column_name"])

    def per_column(values: dict[str, int]) -> Column:
        picked = F.lit(None).cast("bigint")
        for c, v in values.items():
            picked = F.when(F.col("column_name") == c, F.lit(v).cast("bigint")).otherwise(picked)
        return picked

    first = per_column(below) + F.col("earlier")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < first + F.col("n")), F.col("value")))

    low = per_column({c: (found[c]["n"] - 1) // 2 for c in ranges})
    high = per_column({c: found[c]["n"] // 2 for c in ranges})
    return placed.groupBy("column_name").agg(((at(low) + at(high)) / 2.0).alias("median"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of every column, the smallest one on ties."""
    counted = (
        df.select(*columns)
        .unpivot([], list(columns), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("value").alias("mode")))
    return counted.groupBy("column_name").agg(best.alias("b")).select("column_name", "b.mode")


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the median of their column."""
    found = {r["column_name"]: r["median"] for r in exact_medians(df, columns).collect()}
    typed = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return typed.na.fill(found) if found else typed


def fill_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the most frequent value of their column."""
    found = {r["column_name"]: r["mode"] for r in modes(df, columns).collect()}
    return df.na.fill(found) if found else df


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as (x - mean) / population deviation; a constant becomes 0."""
    figures = df.agg(
        *[F.avg(c).alias(f"{c}__m") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__s") for c in columns],
    ).first()
    scaled = {}
    for c in columns:
        mean, spread = figures[f"{c}__m"], figures[f"{c}__s"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(spread if spread else 1.0)
    return df.withColumns(scaled)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = counted.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")))
    return counted.withColumn("__w", whole.scalar()).select(
        "label", "n", (F.col("__w.rows") / (F.col("__w.classes") * F.col("n"))).alias("weight")
    )


# ---- classifier metrics ------------------------------------------------------


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are first counted per distinct score; the rank of a score is the
    running number of negatives below it.
    """
    per_score = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = prior_totals(per_score, [score], {"neg_below": F.col("neg")})
    exact = "decimal(19,0)"
    wins = F.col("pos").cast(exact) * (2 * F.col("neg_below") + F.col("neg")).cast(exact)
    return ranked.agg(
        F.sum(wins).cast("double").alias("double_wins"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    ).select(
        "n_pos",
        "n_neg",
        (F.col("double_wins") / 2.0 / F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))).alias("roc_auc"),
    )


def _confusion_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(
        *[
            F.count_if((F.col(label) == t) & (F.col(predicted) == p)).alias(f"n{t}{p}")
            for t in (0, 1)
            for p in (0, 1)
        ]
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Four rows of label, prediction and count; absent pairs are 0."""
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("label"), F.lit(p).alias("predicted"), F.col(f"n{t}{p}").alias("n"))
            for t in (0, 1)
            for p in (0, 1)
        ]
    )
    return _confusion_counts(df, label, predicted).select(F.inline(cells))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, their means, and accuracy."""

    def over(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    figures = _confusion_counts(df, label, predicted)
    for t in (0, 1):
        hit = F.col(f"n{t}{t}")
        figures = (
            figures.withColumn(f"support{t}", F.col(f"n{t}0") + F.col(f"n{t}1"))
            .withColumn(f"precision{t}", over(hit, F.col(f"n0{t}") + F.col(f"n1{t}")))
            .withColumn(f"recall{t}", over(hit, F.col(f"support{t}")))
            .withColumn(
                f"f1{t}",
                over(
                    2 * F.col(f"precision{t}") * F.col(f"recall{t}"),
                    F.col(f"precision{t}") + F.col(f"recall{t}"),
                ),
            )
        )
    total = F.col("support0") + F.col("support1")
    names = ("precision", "recall", "f1")

    def line(name: str, values: list[Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("line"),
            *[v.alias(n) for n, v in zip(names, values)],
            support.alias("support"),
        )

    macro = [(F.col(f"{n}0") + F.col(f"{n}1")) / 2.0 for n in names]
    weighted = [
        over(F.col(f"{n}0") * F.col("support0") + F.col(f"{n}1") * F.col("support1"), total)
        for n in names
    ]
    accuracy = over(F.col("n00") + F.col("n11"), total)
    lines = F.array(
        line("on_time", [F.col(f"{n}0") for n in names], F.col("support0")),
        line("late", [F.col(f"{n}1") for n in names], F.col("support1")),
        line("accuracy", [accuracy, accuracy, accuracy], total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    )
    return figures.select(F.inline(lines))


def threshold_scores(df: DataFrame, score: str, threshold: float = 0.5, digits: int = 4) -> DataFrame:
    """Rounded probability plus the label decided on the unrounded one."""
    from parcelight.functions.numbers import round_half_up

    return df.withColumns(
        {
            "late_probability": round_half_up(F.col(score), digits),
            "predicted_late": (F.col(score) >= threshold).cast("int"),
        }
    )
