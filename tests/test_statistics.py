import random
import statistics

import pytest

from parcelight.operators import statistics as stats
from parcelight.operators.sampling import seeded_sample


def test_medians_and_modes(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice([None, 1.0, 1.0, 2.5, rng.random()]), rng.randrange(9), rng.choice(["b", "a", None]))
        for _ in range(500)
    ]
    frame = spark.createDataFrame(rows, "x double, y int, z string")
    got = {r[0]: r[1] for r in stats.exact_medians(frame, ["x", "y"]).collect()}
    assert got["x"] == statistics.median(r[0] for r in rows if r[0] is not None)
    assert got["y"] == statistics.median(r[1] for r in rows)
    values = [r[2] for r in rows if r[2]]
    assert stats.modes(frame, ["z"]).first()["mode"] == min(set(values), key=lambda v: (-values.count(v), v))


@pytest.mark.parametrize("width", [0.001, 0.2, -0.3])
def test_medians_of_many_values(spark, monkeypatch, width):
    """Also with a range that misses the middle (a negative width)."""
    monkeypatch.setattr(stats, "_NEAR_MIDDLE", width)
    rng = random.Random(8)
    rows = [(rng.gauss(0, 1), float(i % 3), None if i % 2 else float("nan")) for i in range(3001)]
    frame = spark.createDataFrame(rows, "x double, y double, z double")
    got = {r[0]: r[1] for r in stats.exact_medians(frame, ["x", "y", "z"]).collect()}
    assert got == {"x": statistics.median(r[0] for r in rows), "y": statistics.median(r[1] for r in rows)}


def test_mode_ties_take_the_smallest(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,)], "z string")
    assert [r[0] for r in stats.fill_modes(frame, ["z"]).collect()] == ["b", "a", "a"]


def test_all_null_column_stays_null(spark):
    frame = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    assert [tuple(r) for r in stats.fill_medians(frame, ["x", "y"]).collect()] == [(None, 1.0), (None, 3.0)]


def test_standardize_constant_column(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert [tuple(r) for r in stats.standardize(frame, ["x", "y"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_auc_with_ties_equals_all_pairs(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(12) / 10, rng.randrange(2)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert stats.roc_auc(frame, "score", "label").first()["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))


def test_auc_of_one_class_is_unknown(spark):
    frame = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert stats.roc_auc(frame, "score", "label").first()["roc_auc"] is None


def test_report_without_predictions_of_a_class(spark):
    frame = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, p int")
    lines = {r["line"]: r for r in stats.classification_report(frame, "label", "p").collect()}
    assert (lines["late"]["precision"], lines["late"]["f1"], lines["late"]["support"]) == (0.0, 0.0, 1)
    assert lines["accuracy"]["f1"] == pytest.approx(2 / 3)
    cells = {(r[0], r[1]): r[2] for r in stats.confusion_matrix(frame, "label", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_weights_are_balanced(spark):
    frame = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    got = {r["label"]: r["weight"] for r in stats.class_weights(frame, "y").collect()}
    assert got == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_sample_is_independent_of_partitioning(spark):
    frame = spark.range(500)
    picked = lambda df: {r[0] for r in seeded_sample(df, "id", 40).collect()}
    assert picked(frame) == picked(frame.repartition(7)) and len(picked(frame)) == 40
    assert seeded_sample(frame, "id", 600).count() == 500
    assert {r[0] for r in seeded_sample(frame, "id", 40, seed=1).collect()} != picked(frame)
