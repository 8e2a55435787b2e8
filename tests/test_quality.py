import pytest
from pyspark.sql import functions as F

from parcelight.operators import quality
from parcelight.plans.reviews import review_table

SCHEMA = (
    "review_id long, clothing_id long, age int, title string, review_text string, rating int,"
    " recommended_ind int, positive_feedback_count int, division_name string,"
    " department_name string, class_name string"
)


def _row(i, age=30, title="t", review="fine", rating=5, dept="Tops", cls="Knits", div="General"):
    return (i, 1, age, title, review, rating, 1, 0, div, dept, cls)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            _row(1), _row(2), _row(3, title=None), _row(4, title=None), _row(5, review=None),
            _row(6, dept=None), _row(7, rating=9), _row(8, rating=0, age=17), _row(9, age=None),
        ],
        SCHEMA,
    )


def test_duplicates_treat_null_as_equal(raw):
    content = [c for c in raw.columns if c != "review_id"]
    got = quality.duplicate_profile(raw, content).first()
    assert (got["n_rows"], got["duplicate_rows"]) == (9, 2)
    assert quality.duplicate_profile(raw, raw.columns).first()["duplicate_rows"] == 0


def test_copies_keep_the_lowest_key(raw):
    kept = {r["review_id"] for r in quality.drop_copies(raw).collect()}
    assert kept == {1, 3, 5, 6, 7, 8, 9}
    assert quality.drop_copies(raw.drop("review_id"), None).count() == 7
    whole = {r["review_id"]: tuple(r) for r in raw.collect()}
    assert all(tuple(r) == whole[r["review_id"]] for r in quality.drop_copies(raw).collect())


def test_ages_are_clipped_only_when_one_is_impossible(spark, raw):
    ages = lambda df: {r["review_id"]: r["age"] for r in df.collect()}
    assert ages(quality.clean_reviews(raw))[8] == 17
    worse = raw.union(spark.createDataFrame([_row(10, age=130)], SCHEMA))
    got = ages(quality.clean_reviews(worse))
    assert (got[8], got[10], got[9]) == (18, 100, None)


def test_ratings_are_clipped(raw):
    got = {r["review_id"]: r["rating"] for r in quality.clean_reviews(raw).collect()}
    assert (got[7], got[8]) == (5, 1)


def test_audit_follows_the_cleaning(raw):
    steps = quality.clean_audit(raw).orderBy("step").collect()
    assert [(s["rows_before"], s["rows_after"], s["rows_dropped"]) for s in steps] == [
        (9, 8, 1), (8, 7, 1), (7, 5, 2), (5, 5, 0),
    ]
    assert (steps[3]["ratings_clipped"], steps[3]["ages_out_of_range"]) == (2, 0)
    assert quality.clean_reviews(raw).count() == 5


def test_profiles(raw):
    nulls = {r["column_name"]: r["null_count"] for r in quality.null_profile(raw).collect()}
    assert (nulls["title"], nulls["review_text"], nulls["rating"]) == (2, 1, 0)
    counts = {(r["column_name"], r["value"]): r["n"] for r in quality.value_counts(raw, ["rating", "department_name"]).collect()}
    assert counts[("rating", "5")] == 7 and counts[("department_name", "Tops")] == 8
    assert ("department_name", None) not in counts
    outliers = {(r["column_name"], r["value"]): r["n"] for r in quality.outlier_profile(raw).collect()}
    assert outliers == {("rating", 9): 1, ("rating", 0): 1}


def test_empty_table(raw):
    nothing = raw.limit(0)
    assert quality.clean_audit(nothing).count() == 4
    assert quality.null_profile(nothing).where(F.col("null_pct") == 0).count() == 11
    assert review_table(nothing).count() == 0


def test_tidy_names(spark):
    frame = spark.createDataFrame([(0, 5, 40)], "`Unnamed: 0` int, `Clothing ID` int, `Age` int")
    assert quality.tidy_names(frame).columns == ["clothing_id", "age"]


def test_defaults_and_kinds(spark):
    frame = spark.createDataFrame([(None, 1.5)], "a string, b double")
    row = quality.with_defaults(frame, {"a": "Unknown", "c": 0}).first()
    assert (row["a"], row["c"]) == ("Unknown", 0)
    assert quality.split_by_kind(frame) == (["b"], ["a"])
