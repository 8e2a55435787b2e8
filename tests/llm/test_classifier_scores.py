"""Scores of the two classifiers against plain loops over words, filters and thresholds."""

import math

import numpy as np

from parcelight.llm import quality_classifier, toxicity

TEXTS = [
    "", " ", "one", "two words", "a b c d e f g h", "Again again, again!", "été 数据 x" * 20,
    " ".join(f"w{i}" for i in range(300)),
]


def _slow_toxicity(model, words):
    vectors = [np.mean([model.embeddings[b].astype(float) for b in model.buckets(w)], axis=0) for w in words]
    total, n = model.intercept, 0
    for f, b in zip(model.filters, model.biases, strict=True):
        for c in range(f.shape[2]):
            best = 0.0  # a window may reach over the end, where it reads zeros
            for at in range(len(words)):
                inside = range(min(len(f), len(words) - at))
                best = max(best, float(b[c]) + sum(float(vectors[at + k] @ f[k, :, c]) for k in inside))
            total += model.weights[n] * best
            n += 1
    return 1 / (1 + math.exp(-min(max(total, -30), 30)))


def test_toxicity_equals_plain_convolution():
    for seed in range(5):
        rng = np.random.default_rng(seed)
        model = toxicity.ToxicityModel(
            rng.normal(0, 1, (64, 3)).astype(np.float32),
            [rng.normal(0, 1, (w, 3, 2)).astype(np.float32) for w in toxicity.WIDTHS],
            [rng.normal(0, 1, 2).astype(np.float32) for _ in toxicity.WIDTHS],
            rng.normal(0, 1, 2 * len(toxicity.WIDTHS)),
            0.3,
        )
        words = [toxicity.words_of(t) for t in TEXTS]
        got = model.scores(words, toxicity.WordCache(model))
        assert np.allclose(got, [_slow_toxicity(model, w) for w in words], atol=1e-5)
        alone = [model.scores([w], toxicity.WordCache(model))[0] for w in words]
        assert np.allclose(got, alone, atol=1e-5)  # neighbours in a batch do not reach into a text


def test_grades_equal_plain_sums(spark):
    rng = np.random.default_rng(3)
    weights, cuts = rng.normal(0, 1, 64).astype(np.float32), [-0.4, 0.9]
    model = quality_classifier.OrdinalModel(weights, np.array(cuts))
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in quality_classifier.grade_documents(frame, model).collect()}
    assert set(got) == set(range(len(TEXTS)))
    for i, text in enumerate(TEXTS):
        at, share = quality_classifier.features(text, quality_classifier.Places(len(weights)))
        position = sum(float(weights[p]) * float(s) for p, s in zip(at, share, strict=True))
        tails = [1 / (1 + math.exp(-(position - c))) for c in cuts]
        assert np.allclose(got[i]["tails"], tails, atol=1e-5)
        assert abs(got[i]["expected_grade"] - sum(tails)) < 1e-5
