"""Tokens of more than 64 characters, as texts without blanks have, are read to their end."""

import numpy as np
import pytest

from parcelight.llm import toxicity


@pytest.fixture(scope="module")
def trained():
    """A model of texts with blanks, and the words of texts that it has not seen."""
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abdegilmnorstu"), 6))
    texts = [[word() for _ in range(60)] for _ in range(400)]
    for words in texts[::4]:
        for _ in range(2):
            words[int(rng.integers(60))] = "zzkkx" + word()
    labels = [int(i % 4 == 0) for i in range(400)]
    return toxicity.fit_toxicity([" ".join(t) for t in texts[:300]], labels[:300], ["en"] * 300, 0.25), texts[300:], labels[300:]


@pytest.mark.parametrize("between", ["", "_", ","])
def test_toxic_words_late_in_a_token(trained, between):
    model, texts, labels = trained
    # toxic words stand behind 30 others, 180 characters or more
    late = [[w for w in t if w[:5] != "zzkkx"] for t in texts]
    late = [[*c[:30], *[w for w in t if w[:5] == "zzkkx"], *c[30:]] for c, t in zip(late, texts, strict=True)]
    scores = model.scores([toxicity.words_of(between.join(t)) for t in late], toxicity.WordCache(model))
    assert ((scores >= 0.5) == np.array(labels, bool)).mean() > 0.95


def test_every_character_is_in_a_piece():
    rng = np.random.default_rng(4)
    for n in range(1, 300):
        token = "".join(rng.choice(list("漢字仮名交文日本語中国"), n))
        pieces = toxicity.words_of(token)
        assert all(any(token[i : i + 8] in p for p in pieces) for i in range(n))
        assert pieces == [token] if n <= 64 else max(map(len, pieces)) <= 16
    assert toxicity.words_of("A (b) " + "." * 70 + "c") == ["a", "(b)", "." * 70 + "c"]
    assert "".join(toxicity.words_of("-" * 70)).count("-") >= 70
