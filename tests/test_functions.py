from datetime import date, datetime

from pyspark.sql import functions as F

from parcelight.functions import dates, numbers, text


def _one(spark, value, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], "x string").select(column).collect()]


def test_words_split_like_a_plain_split(spark):
    samples = ["", " a  b ", "one", "a\tb\nc\r\nd", "x y z　w", "q\x1cr\x85s", "  ", None]
    got = _one(spark, samples, text.words(F.col("x")))
    assert got == [None if s is None else s.split() for s in samples]
    assert _one(spark, samples, text.word_count(F.col("x")))[:3] == [0, 2, 1]


def test_strip_code_fence(spark):
    cases = {
        "  plain  ": "plain",
        "```json\n{}\n```": "{}",
        "```\n{}\n```  \n": "{}",
        "```json\n{}": "{}",
        "```json": "",
        "```{}```": "",
        "{} ```": "{} ```",
        "```\na\n``` b": "a\n``` b",
        "```json\r\n{}\r\n```": "{}",
    }
    assert _one(spark, cases, text.strip_code_fence(F.col("x"))) == list(cases.values())


def test_age_bucket_and_rank(spark):
    ages = [18, 24, 25, 34, 35, 44, 45, 54, 55, 100, None]
    frame = spark.createDataFrame([(a,) for a in ages], "age int")
    frame = frame.select(text.age_bucket(F.col("age")).alias("b"))
    got = [r["b"] for r in frame.collect()]
    assert got == ["<25", "<25", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+", "55+"]
    ranks = {r[0]: r[1] for r in frame.select("b", text.age_bucket_rank(F.col("b"))).collect()}
    assert [ranks[b] for b in ("<25", "25-34", "35-44", "45-54", "55+")] == [1, 2, 3, 4, 5]


def test_whole_and_floor_days(spark):
    start = datetime(2024, 1, 10, 12)
    ends = [
        datetime(2024, 1, 10, 13), datetime(2024, 1, 11, 12), datetime(2024, 1, 12, 11),
        datetime(2024, 1, 10, 11), datetime(2024, 1, 9, 12), datetime(2024, 1, 8, 13), None,
    ]
    frame = spark.createDataFrame([(start, e) for e in ends], "s timestamp_ntz, e timestamp_ntz")
    got = frame.select(dates.whole_days(F.col("s"), F.col("e")), dates.floor_days(F.col("s"), F.col("e"))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 0, -1, -1, None]
    assert [r[1] for r in got] == [0, 1, 1, -1, -1, -2, None]


def test_weekdays(spark):
    frame = spark.createDataFrame([("Mon",), ("Sun",), ("Noday",), (None,)], "x string")
    assert [r[0] for r in frame.select(dates.weekday_from_label(F.col("x"))).collect()] == [0, 6, None, None]
    monday = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert monday.select(dates.weekday_number(F.col("t"))).first()[0] == 0


def test_on_days_is_inclusive_and_optional(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 2, 23, 59, 59), datetime(2024, 1, 3)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    keep = lambda a, b: frame.where(dates.on_days(F.col("t"), a, b)).count()
    assert keep(date(2024, 1, 1), date(2024, 1, 2)) == 2
    assert keep(date(2024, 1, 2), None) == 3


def test_late_flag_treats_unknown_as_punctual(spark):
    rows = [(datetime(2024, 1, 2), datetime(2024, 1, 1)), (None, datetime(2024, 1, 1)), (datetime(2024, 1, 1), None)]
    frame = spark.createDataFrame(rows, "d timestamp_ntz, p timestamp_ntz")
    assert [r[0] for r in frame.select(dates.is_late(F.col("d"), F.col("p"))).collect()] == [1, 0, 0]


def test_numbers(spark):
    frame = spark.createDataFrame([(1.0, 0.0, 7), (1.0, None, None), (0.285, 2.0, -3)], "a double, b double, c int")
    got = frame.select(
        numbers.safe_ratio(F.col("a"), F.col("b")), numbers.clip(F.col("c"), 1, 5), numbers.round_half_up(F.col("a"), 2)
    ).collect()
    assert [r[0] for r in got] == [None, None, 0.1425]
    assert [r[1] for r in got] == [5, None, 1]
    assert [r[2] for r in got][:2] == [1.0, 1.0]
