"""Lexical search, collocations and shards against plain versions, and on awkward tables."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.llm import collocations, common, lexical_search, queries, sharding
from tests.llm.test_text_operators import AWKWARD, frame

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def awkward(spark):
    common.prepared(spark)
    return frame(spark, AWKWARD).checkpoint()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_collocations", "op13_sharding"])
def test_matches_sql(name, spark, duck):
    theirs = duck.sql(queries.SQL[name])
    ours = queries.QUERIES[name](spark, FOLDER).select(*theirs.columns)
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(theirs.fetchall(), key=str)


# lexical search


def brute_search(rows, items, hits=10):
    docs = [(i, Counter(lexical_search.terms_of(t or ""))) for i, t in rows]
    n_docs = sum(1 for _, bag in docs if bag)
    n_terms = sum(sum(bag.values()) for _, bag in docs)
    df = Counter(t for _, bag in docs for t in bag)
    out = []
    for item, text in items:
        asked = Counter(lexical_search.terms_of(text or ""))
        scores = []
        for i, bag in docs:
            m = 100 - 75 + (75 * sum(bag.values()) * n_docs) // max(n_terms, 1)
            score = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t, c in asked.items() if t in bag
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:hits], 1)]
    return sorted(out, key=str)


def test_search_on_awkward_tables(spark, awkward):
    items = [(1, "same words in text"), (1, "word1 word2 Word3"), (None, "a TEXT without"), (2, None), (3, "zzz"), (4, "ä-ö x")]
    asked = frame(spark, [(0, t, None, None) for _, t in items]).limit(0).select("*", F.lit(0).alias("item_id"))
    assert lexical_search.search(awkward, asked).count() == 0
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id int, text string, doc_id string, __row int")
    want = brute_search([(r[0], r[1]) for r in AWKWARD], items)
    for block_bytes in (10, 10**6):
        got = lexical_search.search(awkward, asked, block_bytes=block_bytes).select("item_id", "rank", "doc_id", "score")
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert lexical_search.search(awkward.limit(0), asked).count() == 0


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(1)
    words = [f"w{n}" for n in range(400)]
    weights = 1 / np.arange(1, 401)
    texts = [" ".join(rng.choice(words, rng.integers(5, 60), p=weights / weights.sum())) for _ in range(1500)]
    items = [" ".join(rng.choice(words, 12)) for _ in range(15)]
    vocabulary, bags = lexical_search.numbered_terms(items)
    docs = [lexical_search.terms_of(t) for t in texts]
    held = Counter(t for d in docs for t in set(d))
    told = lexical_search.weighed(
        vocabulary, bags, {n: held[t] for t, n in vocabulary.items()}, len(docs), sum(map(len, docs))
    )
    best = lexical_search.Best(10)
    for at in range(0, 1500, 500):
        segment = lexical_search.Segment()
        for n in range(at, at + 500):
            segment.add(n, texts[n], told)
        lexical_search.search_segment(segment, told, best, 16)
    want = brute_search(list(enumerate(texts)), list(enumerate(items)))
    got = [(item, rank, d, -s) for item, hits in best.held.items() for rank, (s, _, d) in enumerate(hits, 1)]
    assert sorted(got, key=str) == want
    assert best.skipped > best.evaluated / 20


def test_blocks_hold_similar_documents():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 8)) * 50
    points = np.concatenate([c + rng.normal(size=(32, 8)) for c in centres])
    order, starts = lexical_search.geometric_blocks(rng.permutation(128), points, 32)
    assert sorted(order.tolist()) == list(range(128)) and starts.tolist() == [0, 32, 64, 96]
    assert [len({d // 32 for d in order[s : s + 32].tolist()}) for s in starts] == [1, 1, 1, 1]


# collocations


def brute_counts(rows):
    counts = Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", 0, ""] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts[lang or "und", n, " ".join(words[i : i + n])] += 1
    return counts


@pytest.mark.parametrize(("share", "bits"), [(0.0, 26), (0.3, 26), (1.0, 26), (0.3, 6)])
def test_counts_are_exact_whatever_the_sample(spark, share, bits):
    rng = np.random.default_rng(5)
    words = [*"abcdefgh", "ß", "x\x00y", " ", "Q"]
    rows = [(("en", "de", None)[n % 3], " ".join(rng.choice(words, 30)) + ("! \tA\x0bb" if n % 4 else "")) for n in range(60)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, a int, phrase string")
    report = []
    found = collocations.frequent_phrases(docs, 4, sample_share=share, map_bits=bits, report=report)
    got = {(r.lang, r["size"], r.phrase): r.a for r in found.collect()}
    assert got == {k: a for k, a in brute_counts(rows).items() if a >= 4 or k[1] == 0}
    assert report[-1] == 0 and (share < 1 or len(report) == 1)


def test_collocations_on_awkward_tables(spark, awkward):
    found = collocations.collocations(awkward, least=2).collect()
    assert {r.phrase for r in found} >= {"same words in", "in this text", "this text here"}
    assert all(r.score == 1000000 * r.a * r.a // (r.l * r.r) for r in found)
    assert collocations.collocations(awkward.limit(0)).count() == 0
    words = spark.createDataFrame([("en", "a b " * 6000)], "lang string, text string")
    top = collocations.collocations(words).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in top] == [("a b a", 5999, 6000, 6000, 12000), ("b a b", 5999, 6000, 6000, 12000)]


# shards


def test_shards_on_awkward_tables(spark, awkward):
    got = sharding.interleave(awkward, shards=4, keep=("score", "size")).collect()
    assert len(got) == len(AWKWARD)
    texts = [r[1] or "" for r in AWKWARD]
    assert sorted(r.text_crc32 for r in got) == sorted(zlib.crc32(t.encode()) for t in texts)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    again = sharding.interleave(awkward.repartition(3), shards=4).collect()
    place = lambda rows: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in rows)
    assert place(again) == place(got)
    assert sharding.interleave(awkward.limit(0)).count() == 0


def test_every_shard_has_the_mixture(spark):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 == 0 else f"s{i % 40}" if i % 2 else f"only{i}") for i in range(4000)]
    got = sharding.interleave(frame(spark, rows), shards=10, keep=("source",)).toPandas()
    hot = got[got["source"] == "hot"].groupby("shard").size()
    assert len(hot) == 10 and hot.max() - hot.min() <= 40
    rare = got[got["source"].str.startswith("only")].groupby("shard").size()
    assert rare.min() > 0.7 * rare.mean() and rare.max() < 1.3 * rare.mean()


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i % 50}", "en", f"s{i % 7}") for i in range(500)]
    stored = str(tmp_path / "in")
    frame(spark, rows).withColumn("shard", F.lit("own")).write.parquet(stored)
    docs = spark.read.parquet(stored)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=5, file_rows=40)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().orderBy("shard").collect() == [(k, 100) for k in range(5)]
    assert sorted(back.select("doc_id", "text", "shard_").collect()) == sorted(docs.select("doc_id", "text", "shard").collect())
