import json

import pandas as pd
import pytest

from parcelight.plans import extraction as ex

GOOD = json.dumps({"sentiment": "neutral", "complaint_category": "none", "would_recommend_reason": "ok"})


def test_rerun_asks_only_what_is_open(spark, tmp_path):
    calls, log = tmp_path / "calls", str(tmp_path / "log")
    reviews = spark.createDataFrame([(i, f"text {i % 40}" if i != 7 else None) for i in range(50)], "review_id long, review_text string")

    def answer(batch: pd.DataFrame) -> list:
        with open(calls, "a") as file:
            for text in batch["user_text"]:
                file.write(text + "\n")
        if any("text 13" in t for t in batch["user_text"]) and not (tmp_path / "mended").exists():
            raise ConnectionError("service away")
        return [GOOD] * len(batch)

    ask = lambda: ex.logged_answers(ex.prompt_build(reviews), answer, log, rows=1, slices=3)
    with pytest.raises(ex.AnswersMissing, match="ConnectionError: service away"):
        ask()
    (tmp_path / "mended").touch()
    got = ask().collect()
    assert len(got) == 49 and all(r["raw"] == GOOD for r in got)
    asked = calls.read_text().splitlines()
    assert asked.count('Review: "text 13"') == 2  # the one that failed, again
    assert len(asked) == 41 and len(set(asked)) == 40
    ask().collect()
    assert len(calls.read_text().splitlines()) == 41


def test_extract_with_a_log_gives_what_it_gives_without(spark, tmp_path):
    reviews = spark.createDataFrame([(i, f"text {i}") for i in range(12)], "review_id long, review_text string")
    answer = lambda batch: [GOOD if "1" in t else "not json" for t in batch["user_text"]]
    plain = sorted(ex.extract(reviews, answer).collect())
    assert sorted(ex.extract(reviews, answer, log=str(tmp_path / "log")).select(*ex.extract(reviews, answer).columns).collect()) == plain
