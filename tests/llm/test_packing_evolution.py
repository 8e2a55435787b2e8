"""Evolution, migration and the pieces of documents."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from parcelight.llm import packing


def _triplets(n: int, capacity: int, seed: int) -> np.ndarray:
    """Sizes of which three fill a bin exactly; best fit puts the wrong ones together."""
    rng = np.random.default_rng(seed)
    first = rng.integers(capacity * 38 // 100, capacity * 49 // 100, n)
    second = rng.integers(capacity // 4, (capacity - first) // 2 + 1)
    return np.concatenate([first, second, capacity - first - second]).astype(np.int64)


def _valid(best: packing.Packing, sizes: np.ndarray) -> None:
    placed = sorted(i for b in best.bins for i in b)
    assert placed == list(range(len(sizes)))
    assert all(sizes[b].sum() == f <= best.capacity for b, f in zip(best.bins, best.fill, strict=True))


def test_evolution_needs_fewer_bins_than_best_fit():
    saved = 0
    for seed in (0, 1, 2, 3):
        sizes = np.random.default_rng(seed).integers(250, 501, 60)
        plain = packing.Packing(sizes, 1000).place(packing._descending(sizes, np.arange(60)))
        best = packing.evolve(sizes, 1000, seed, population=16, generations=120)
        _valid(best, sizes)
        assert len(best.bins) <= len(plain.bins)
        saved += len(plain.bins) - len(best.bins)
    assert saved >= 2


def test_migrated_elite_is_injected():
    sizes = _triplets(20, 1000, 1)
    elite = [[i, 20 + i, 40 + i] for i in range(18)]  # full bins from other islands
    rest = [[i] for i in (18, 19, 38, 39, 58, 59)]
    plain = packing.Packing(sizes, 1000).place(packing._descending(sizes, np.arange(60)))
    best = packing.evolve(sizes, 1000, 3, [*elite, *rest])
    _valid(best, sizes)
    kept = {tuple(sorted(b)) for b in best.bins}
    assert len(best.bins) < len(plain.bins) and sum(tuple(sorted(b)) in kept for b in elite) > 10


def test_crossover_keeps_every_document_once():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1000, 300)
    a = packing.Packing(sizes, 1000).place(packing._descending(sizes, np.arange(300)))
    b = packing.Packing(sizes, 1000).place(rng.permutation(300).tolist())
    for _ in range(20):
        child = packing.crossover(a, b, rng)
        _valid(child, sizes)
        a, b = b, child


def test_emigrants_are_the_fullest():
    best = packing.Packing(np.array([10, 9, 10, 4]), 10).holding([[0], [1], [2], [3]])
    assert packing.emigrants(best, 0.9, 0.7) == {0, 2}
    assert packing.emigrants(best, 0.9, 0.0) == set()


def test_bins_migrate_between_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(n, int(s)) for n, s in enumerate(rng.integers(200, 1000, 900))]
    pieces = spark.createDataFrame(rows, "doc_id long, length long")
    got = packing.pack(pieces, sequence=1000, island=150, rounds=3, share=0.5, elite=0.98).toPandas()
    assert sorted(got["doc_id"]) == list(range(900))
    assert (got.groupby("sequence_id")["length"].sum() <= 1000).all()
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert (rows["offset"] == rows["length"].cumsum() - rows["length"]).all()


def test_pieces_are_those_of_the_tokenizer(spark):
    path = packing.default_tokenizer()
    whole = Tokenizer.from_file(path)
    texts = [
        "", None, "plain words, and words. And WORDS!? plain", "über Straße ñandú; İstanbul ŉ ſ ÿ ß", "a\x1cb c\x1fd", "中文 text 日本語",
        "café résumé,", "x" * 3000 + " y", "don't can't 12,5% #tag *bold* e-mail@x.org", " \t\n ", "word " * 700, "ﬁne ǅ ª º µ",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.token_pieces(docs, path, 64).toPandas()
    for n, text in enumerate(texts):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, packing.END_OF_TEXT]
        rows = got[got["doc_id"] == n].sort_values("piece")
        parts = [ids[at : at + 64] for at in range(0, len(ids), 64)]
        assert rows["piece"].tolist() == list(range(len(parts)))
        assert rows["start"].tolist() == list(range(0, len(ids), 64))
        assert rows["length"].tolist() == [len(p) for p in parts]
        assert rows["ids_crc32"].tolist() == [zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts]


@pytest.mark.parametrize("cap", [3, 50])
def test_words_keep_their_ids_when_the_cache_turns_over(monkeypatch, cap):
    monkeypatch.setattr(packing, "_CACHED_WORDS", cap)
    path = packing.default_tokenizer()
    whole, tokens = Tokenizer.from_file(path), packing.WordTokens(path)
    rng = np.random.default_rng(4)
    words = ["one", "two,", "two", "größe!", "größe", "3rd", "ein", "a-b", "x.y", "naïve;"]
    for _ in range(40):
        texts = [" ".join(rng.choice(words, 12)) + f" w{rng.integers(99)}{'z' * rng.integers(5)}," for _ in range(4)]
        want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert list(tokens.many(texts)) == want
