"""Leaves cut by content and likeness by descent, against a plain version."""

import hashlib
import random
import re

import pytest
import xxhash

from parcelight.llm import common, fingerprints
from tests.llm.test_text_operators import by_id, frame


def leaves(text):
    out = set()
    for line in text.split("\n"):
        run = []
        for word in re.findall(r"[^\x20\x09-\x0D]+", line):
            run.append(word)
            if xxhash.xxh64_intdigest(word.encode(), seed=42) % 4 == 0:
                out.add(" ".join(run))
                run = []
        if run:
            out.add(" ".join(run))
    return out


def sections(text):
    out, held = [], []
    for line in text.split("\n"):
        held.append(line)
        if hashlib.sha256(line.encode()).hexdigest().endswith("0"):
            out.append(tuple(held))
            held = []
    return out + ([tuple(held)] if held else [])


def likeness(a, b):
    both = len(leaves(a)) + len(leaves(b))
    one = {p for s in set(sections(a)) - set(sections(b)) for p in s}
    two = {p for s in set(sections(b)) - set(sections(a)) for p in s}
    left, right = leaves("\n".join(one - two)), leaves("\n".join(two - one))
    return 1 - len(left ^ right) / both if both else 1.0


def near(spark, texts):
    common.prepared(spark)
    rows = by_id(fingerprints.fingerprint_edits(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])))
    return [rows[i] for i in range(len(texts))]


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_against_plain_version(spark):
    rng = random.Random(5)
    lines = [" ".join(words(rng.randrange(12), k)) for k in range(60)]
    texts = ["", "\n\n;\n", "a  b\tc \n;x", "é 漢字 🙂\n\n", " ; \n;\n;"]
    texts += ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 50))) for _ in range(40)]
    for i, row in enumerate(near(spark, texts)):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert row.near_next == pytest.approx(likeness(text, following), abs=1e-12)
        assert row.near_edited == pytest.approx(likeness(text, edited), abs=1e-12)
        assert 0 <= row.near_next <= 1


def test_one_word_moves_no_other_leaf(spark):
    line = words(400, 1)
    inside = [*line[:200], "more", *line[200:]]
    found = near(spark, [" ".join(line), " ".join(["first", *line]), " ".join(line), " ".join(inside), "other " + " ".join(words(400, 2))])
    assert all(r.near_next > 0.95 for r in found[:3])
    assert found[3].near_next < 0.1


@pytest.mark.parametrize("change", ["insert", "remove", "move"])
def test_one_line_changed(spark, change):
    lines = [" ".join(words(20, k)) for k in range(80)]
    other = list(lines)
    line = other.pop(30) if change != "insert" else " ".join(words(20, 999))
    if change != "remove":
        other.insert(60, line)
    row = near(spark, ["\n".join(lines), "\n".join(other)])[0]
    assert row.near_next == 1.0 if change == "move" else 0.95 < row.near_next < 1
    assert row.near_next == pytest.approx(likeness("\n".join(lines), "\n".join(other)), abs=1e-12)
