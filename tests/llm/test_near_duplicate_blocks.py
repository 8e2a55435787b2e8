"""Blocks of a large group whose texts repeat their own lines, against brute force."""

import random

import pytest

from parcelight.llm import common, near_duplicates
from tests.llm.test_text_operators import brute_links, by_id, frame


@pytest.mark.parametrize("times", [2, 5])
def test_repeated_passages_meet_across_blocks(spark, tmp_path, times):
    common.prepared(spark)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(90):
        words = list(base)
        words[rng.randrange(len(words))] = f"z{i}"
        texts[i] = "\n".join([" ".join(words)] * (times if i % 2 else 1))
    path = str(tmp_path / "t")
    frame(spark, [(i, t, "en", "a") for i, t in texts.items()]).write.parquet(path)
    links, classes = brute_links(texts)
    assert any(len(t.split()) > 120 and links[i] > 45 for i, t in texts.items())
    found = by_id(near_duplicates.near_duplicates(spark.read.parquet(path), block=16))
    assert {i: r.n_links for i, r in found.items()} == {i: links[i] for i in texts}
    assert {i: r.class_id for i, r in found.items()} == classes
