import json

import pandas as pd
import pytest

from parcelight.plans import extraction as ex

GOOD = '{"sentiment": "negative", "complaint_category": "sizing", "would_recommend_reason": "small"}'
NULL_VALUE = '{"sentiment": null, "complaint_category": "none", "would_recommend_reason": "x"}'


@pytest.mark.parametrize(
    "raw, expected",
    [
        (GOOD, ("negative", "sizing", "small")),
        (f"  {GOOD}\n", ("negative", "sizing", "small")),
        (f"```json\n{GOOD}\n```", ("negative", "sizing", "small")),
        (GOOD[:-1] + ', "more": [1, 2]}', ("negative", "sizing", "small")),
        (NULL_VALUE, (None, "none", "x")),
        (GOOD + " and more", None),
        (GOOD + "," + GOOD, None),
        (f"[{GOOD}]", None),
        (GOOD.replace('"', "'"), None),
        (GOOD[:-1], None),
        ('{"sentiment": "neutral"}', None),
        ("not json", None),
        ('"sentiment complaint_category would_recommend_reason"', None),
        ("", None),
        ("null", None),
        (None, None),
    ],
)
def test_parsing(spark, raw, expected):
    row = ex.parse_extractions(spark.createDataFrame([(1, raw)], "review_id long, raw string")).first()
    assert row["parsed_ok"] is (expected is not None)
    assert tuple(row[k] for k in ex.KEYS) == (expected or ex.FALLBACK)


def test_extract_asks_unreadable_ones_once_more(spark, tmp_path):
    """First answers are bad for even ids; the second answer helps id 2 only."""
    reviews = spark.createDataFrame(
        [(1, "one"), (2, "two"), (3, None), (4, "four")], "review_id long, review_text string"
    ).repartition(2)
    seen = str(tmp_path)

    def answer(batch: pd.DataFrame) -> pd.Series:
        import os

        out = []
        for text in batch["user_text"]:
            mark = os.path.join(seen, str(abs(hash(text))))
            first = not os.path.exists(mark)
            open(mark, "a").write("x")
            bad = ("two" in text and first) or "four" in text
            out.append("oops" if bad else GOOD)
        return pd.Series(out)

    got = {r["review_id"]: r for r in ex.extract(reviews, answer).collect()}
    assert set(got) == {1, 2, 4}
    assert got[1]["complaint_category"] == got[2]["complaint_category"] == "sizing"
    assert tuple(got[4][k] for k in ex.KEYS) == ex.FALLBACK and not got[4]["parsed_ok"]


@pytest.fixture
def joined(spark):
    rows = [
        (1, "Tops", 20, "sizing"), (2, "Tops", 30, "fabric"), (3, "Dresses", 60, "none"),
        (4, "Dresses", 60, "odd"), (5, None, 60, "sizing"), (6, "Lounge", 50, "other"), (7, "Lounge", 50, None),
    ]
    return spark.createDataFrame(rows, "review_id long, department_name string, age int, complaint_category string")


def test_matrix_keeps_every_label(joined):
    got = {r["department_name"]: r for r in ex.complaint_matrix(joined, "department_name").collect()}
    assert set(got) == {"Tops", "Dresses", "Lounge"}
    assert (got["Tops"]["sizing"], got["Tops"]["quality"], got["Dresses"]["unlisted"]) == (1, 0, 1)
    counted = ex.complaint_counts(joined, "department_name").groupBy("department_name").sum("n").collect()
    for r in counted:
        row = got[r["department_name"]].asDict()
        assert sum(v for k, v in row.items() if k != "department_name") == r["sum(n)"]


def test_top_complaint_ties_by_name_and_advice(joined):
    top = {r[0]: (r[1], r[2]) for r in ex.top_complaint(joined).collect()}
    assert top == {"Tops": ("fabric", 1), "Dresses": ("none", 1), "Lounge": ("other", 1)}
    advice = {r["department_name"]: r for r in ex.recommendations(joined).collect()}
    assert set(advice) == {"Tops", "Lounge"}
    assert advice["Tops"]["advice"] == ex.ADVICE["fabric"]
    assert advice["Tops"]["notice"] == "Tops: Consider fabric sourcing - 1 fabric complaints"
    assert advice["Lounge"]["advice"] is None and advice["Lounge"]["notice"] == "Lounge: 1 other complaints"


def test_age_bands(joined):
    got = {r["age_bucket"]: r["sizing"] for r in ex.complaints_by_age_bucket(joined).collect()}
    assert got["<25"] == 1 and got["55+"] == 1


def test_prompt(spark):
    frame = spark.createDataFrame([(1, 'says "ok"'), (2, None)], "review_id long, review_text string")
    rows = ex.prompt_build(frame).collect()
    assert [r["user_text"] for r in rows] == ['Review: "says "ok""']
    example = ex.instructions().splitlines()[-1]
    assert set(json.loads(example)) == set(ex.KEYS)
