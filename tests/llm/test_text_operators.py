"""The text operators against brute force, on the small tables and on awkward rows."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelight.llm import (
    common,
    components,
    fingerprints,
    license_scan,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    secret_scan,
    suffix_dedup,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, __row string, spans string, node int"


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, None, 1, "x", "y", "z", 2) for r in rows], SCHEMA).coalesce(2)


LONG = " ".join(f"word{i % 977} licensed" for i in range(30_000))
AWKWARD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \n\t ", "en", "a"),
    (4, LONG, "en", "a"),
    (5, "same words in this text here", "de", "b"),
    (6, "same words in this text here", "de", "b"),
    (6, "same words in this text here", "de", "b"),
    (None, "a text without any id at all", "fr", "b"),
    (7, "x", "xx", "c"),
    (8, "Üben é 漢字 🙂 password = abcdefgh12", "de", None),
]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Stored, as the operators read their documents twice."""
    common.prepared(spark)
    path = str(tmp_path_factory.mktemp("awkward")) + "/t"
    frame(spark, AWKWARD).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def docs(spark, folder):
    return common.documents(spark, folder)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def by_id(result):
    return {r.doc_id: r for r in result.collect()}


# licenses


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def base_places(text):
    words, found = plain_words(text), []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return len(words), found


def test_license_digest(docs, texts):
    for i, row in by_id(license_scan.license_digest(docs)).items():
        n, found = base_places(texts[i])
        places = [k for k, _ in found]
        assert (row.n_words, row.n_base) == (n, len(found))
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_license_rules(spark):
    cases = {
        1: ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        2: ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
        3: ("Released under the MIT License. under the MIT license", "mit"),
        4: ("dual: Apache License, Version 2.0 or cc-by-nc 4.0", "apache-2,cc-by-nc"),
        5: ("Kommt mit den Kindern", ""),
        6: ("GNU Lesser General Public License v2.1 and CC0", "cc0-1,lgpl-2.1"),
    }
    found = by_id(license_scan.license_digest(frame(spark, [(i, t, "en", "a") for i, (t, _) in cases.items()])))
    assert {i: r.labels for i, r in found.items()} == {i: label for i, (_, label) in cases.items()}
    assert len(license_scan.signature_rules()) > 200


def test_no_detection_lies_in_another_of_its_rank(spark):
    text = "licensed under the gnu general public license version 3 or under the terms of the gnu lesser general public license 3 0 license " * 3
    found = license_scan.scan_licenses(frame(spark, [(1, text, "en", "a")])).first().detections
    for d in found:
        assert not any(e is not d and e.start <= d.start and e.end >= d.end and e.priority >= d.priority for e in found)


# near duplicates


def brute_links(texts, similarity=0.8):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links, parent = collections.Counter(), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in holders[g] if j > i).items():
            if n >= similarity * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return links, {i: find(i) for i in sets}


def test_near_duplicates(docs, texts):
    links, classes = brute_links(texts)
    for i, row in by_id(near_duplicates.near_duplicates(docs)).items():
        assert (row.n_links, row.class_id, row.kept) == (links[i], classes[i], classes[i] == i)


def test_large_group_in_blocks(spark, tmp_path):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
        texts[i] = " ".join(words[: 120 - rng.randrange(8)])
    path = str(tmp_path / "t")
    frame(spark, [(i, t, "en", "a") for i, t in texts.items()]).write.parquet(path)
    links, classes = brute_links(texts)
    found = by_id(near_duplicates.near_duplicates(spark.read.parquet(path), block=16))
    assert {i: r.n_links for i, r in found.items()} == {i: links[i] for i in texts}
    assert {i: r.class_id for i, r in found.items()} == classes


def test_near_duplicates_awkward(awkward, empty):
    rows = near_duplicates.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD) and sum(r.kept for r in rows) == len(AWKWARD) - 2
    assert sorted(r.n_links for r in rows) == [0] * 7 + [2] * 3
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert near_duplicates.one_of_each(awkward).columns == awkward.columns


def test_prefix_depth():
    depth = near_duplicates.prefix_depth(0.8, 24, 8, 0.9999)
    assert near_duplicates.recall(0.8, depth, 24) >= 0.9999 > near_duplicates.recall(0.8, depth + 1, 24)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 240)]
    parent = {x: x for e in edges for x in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert found == {i: find(i) for i in linked}


# quality rules


def brute_measures(text):
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(docs, texts, awkward):
    for source, known in ((docs, texts), (awkward, {r[0]: r[1] for r in AWKWARD})):
        for i, r in by_id(quality_rules.quality_rules(source)).items():
            want = brute_measures(known[i])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert r.kept == (not r.base_failed and not r.depleted)


def test_boilerplate_lines(spark, empty):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    notice = " ".join(f"Notice{k}" for k in range(200))
    rows = [(i, f"{own(i)}\n{notice}", "en", "a") for i in range(6)] + [(10, f"{own(10)}\n{notice}", "en", "b")]
    rows += [(20 + i, own(20 + i), "en", None) for i in range(3)]
    found = by_id(quality_rules.quality_rules(frame(spark, rows), least_documents=4))
    assert sorted(i for i, r in found.items() if r.depleted) == list(range(6))
    assert found[0].n_boilerplate_words == 200 and found[10].n_boilerplate_words == 0 and found[10].kept and found[21].kept
    assert quality_rules.quality_rules(empty).count() == 0


# quality classifier and toxicity


def test_ordinal_model_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 300)
    vocabulary = [["bad", "poor", "junk"], ["fair", "plain", "usual"], ["fine", "great", "good"]]
    texts = [" ".join(rng.choice(vocabulary[g], 20)) for g in grades]
    model = quality_classifier.fit_ordinal(texts, grades, np.ones(300), 3, buckets=1 << 12)
    assert (np.diff(model.thresholds) >= 0).all()
    places = quality_classifier.Places(1 << 12)
    position = np.array([model.weights[a] @ s for a, s in (quality_classifier.features(t, places) for t in texts)])
    tails = model.tails(position)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert (np.round(tails.sum(axis=1)).astype(int) == grades).mean() > 0.95


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    found = quality_classifier.quality_grades(common.documents(spark, folder), common.table(spark, folder, "labels"))
    rows = found.join(common.table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.9


def test_classifiers_awkward(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(5, 1, 0), (None, 0, 1), (7, 0, None), (7, None, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, few):
        graded = quality_classifier.quality_grades(awkward, labels).collect()
        assert len(graded) == len(AWKWARD) and all(0 <= r.tail_probability <= 1 for r in graded)
        scored = toxicity.toxicity_scores(awkward, labels).collect()
        assert len(scored) == len(AWKWARD) and all(0 <= r.score <= 1 for r in scored)
    assert quality_classifier.quality_grades(empty, few).count() == toxicity.toxicity_scores(empty, few).count() == 0


def test_toxicity_learns_words_and_prefixes():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abdegilmnorstu"), 6))
    texts, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        if i % 4 == 0:
            words[int(rng.integers(60))] = "zzkkx" + word()
            words[int(rng.integers(60))] = "zzkkx" + word()
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.fit_toxicity(texts[:300], labels[:300], ["en"] * 300, 0.25)
    scores = model.scores([toxicity.words_of(t) for t in texts[300:]], toxicity.WordCache(model))
    assert ((scores >= 0.5) == np.array(labels[300:], bool)).mean() > 0.9
    # a text's score does not depend on its neighbours
    alone = [model.scores([toxicity.words_of(t)], toxicity.WordCache(model))[0] for t in texts[300:310]]
    assert np.allclose(alone, scores[:10], atol=1e-5)


# secrets


def brute_secrets(text):
    a = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in a.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_secret_digest(docs, texts, awkward):
    for source, known in ((docs, texts), (awkward, {r[0]: r[1] for r in AWKWARD})):
        for i, r in by_id(secret_scan.secret_digest(source)).items():
            want = brute_secrets(known[i])
            joined = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in want)
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_weak_parts_need_their_complement(spark, empty):
    key = "AKIA" + "B" * 16
    weak = "client_id = abcd1234"
    cases = {
        1: weak,
        2: f"é {key} and pwd: hunter22 at https://h.example/x",
        3: f"{weak} {'far ' * 80} pwd=hunter22",
        4: "https://h.example/x pwd=hunter22",
        5: f"{weak} pwd=hunter22",
        6: "password: short password: token: abcdefghij PASSWORD='longenough1'",
    }
    found = by_id(secret_scan.secret_digest(frame(spark, [(i, t, "en", "a") for i, t in cases.items()])))
    kinds = {i: [s.split(":")[0] for s in r.spans.split(",") if s] for i, r in found.items()}
    assert kinds[1] == kinds[3] == kinds[4] == []
    assert kinds[2] == ["access", "secret", "endpoint"] and kinds[5] == ["identifier", "secret"]
    assert kinds[6] == ["assign"] and found[2].spans.startswith("access:2:22")
    assert secret_scan.secret_digest(empty).count() == 0


# repeated strings


def test_difference_covers():
    for v, cover in suffix_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def brute_repeats(texts, length):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    count = collections.Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "block"), [(200, 100_000), (20, 6_000), (60, 20_000)])
def test_repeated_spans(spark, folder, texts, length, block):
    found = suffix_dedup.repeated_spans(common.documents(spark, folder), length, block)
    ours = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found.collect()}
    assert ours == brute_repeats(texts, length)


def test_repeats_inside_and_between(spark, tmp_path, empty):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdé") for _ in range(n))
    shared, other = text(300), text(260)
    rows = {1: text(50) + shared + text(70) + shared, 2: shared[:230] + text(9), 3: "é" * 400, 4: other + text(5), 5: text(3) + other[20:] + text(40), 6: None, 7: "", 8: text(150)}
    path = str(tmp_path / "t")
    frame(spark, [(i, t, "en", "a") for i, t in rows.items()]).write.parquet(path)
    found = suffix_dedup.repeated_spans(spark.read.parquet(path), 200, 300)
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found.collect()} == brute_repeats(rows, 200)
    assert suffix_dedup.repeat_digest(empty).count() == 0


# fingerprints


def test_fingerprint_edits(docs, texts):
    ids = sorted(texts)
    found = by_id(fingerprints.fingerprint_edits(docs))
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[i].near_next <= 1 and 0 <= found[i].near_edited <= 1
    roots = collections.defaultdict(set)
    for i, r in found.items():
        roots[r.fingerprint].add(texts[i])
    assert all(len(t) == 1 for t in roots.values()) and len(roots) == len(set(texts.values()))


def test_fingerprints_awkward(spark, awkward, empty):
    rows = fingerprints.fingerprint_edits(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert fingerprints.fingerprint_edits(empty).count() == 0
    alone = fingerprints.fingerprint_edits(frame(spark, [(9, "a b c d e f g h", "en", "a")])).first()
    assert alone.near_next == 1.0


def test_edits_are_located(spark):
    old, new = "one\ntwo\nthree\nfour", "one\ntwo\nthree and more\nfour"
    trees = by_id(fingerprints.merkle_trees(frame(spark, [(1, old, "en", "a"), (2, new, "en", "a")])))
    pair = spark.createDataFrame([(trees[1].paragraphs, trees[2].paragraphs)], "a array<string>, b array<string>")
    assert pair.select(fingerprints.edited_places(F.col("a"), F.col("b"))).first()[0] == [2]


# mixing


def test_mixing_matches_sql(spark, folder, docs):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    theirs = {r[0]: r for r in duck.execute(queries.SQL["op8_mixing"]).fetchall()}
    ours = by_id(mixing.mix_sources(docs))
    assert {i: tuple(r) for i, r in ours.items()} == theirs


def test_water_fill(spark):
    rng = random.Random(8)
    sizes = [rng.choice([0, 5, 70, 900]) + rng.randrange(30) for _ in range(12)]
    weights = [mixing.WEIGHTS[i % 3] for i in range(12)]
    rows = [(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
    total = 1.5 * sum(sizes)
    target, capped = {}, set()
    while True:
        left = total - sum(2 * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        target = {i: 2 * sizes[i] if i in capped else left * weights[i] / open_weight for i in range(12)}
        over = {i for i in target if i not in capped and target[i] > 2 * sizes[i]}
        if not over:
            break
        capped |= over
    sources = spark.createDataFrame(rows, "place long, size long, weight long")
    found = {r.place: r.target for r in mixing.water_fill(sources, total, 2).collect()}
    assert all(abs(found[i] - target[i]) < 1e-6 for i in target)


def test_mixing_awkward(awkward, empty):
    rows = mixing.mix_sources(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix_sources(empty).count() == 0


# packing


@pytest.fixture(scope="module")
def tokens():
    return packing.WordTokens(packing.default_tokenizer())


def test_words_give_the_tokenizers_ids(tokens, texts):
    rng = random.Random(1)
    letters = list("abzAZ'!.,;*#&%-_09 \n\t\x1c\x85\xa0 éÉßİıΣςσ한글ñÑ́̈ǅﬁ①½²ºªµ漢字🙂") + ["'s", "'ll", "don't", "<|endoftext|>"]
    cases = [*texts.values(), *["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]]
    for text, ids in zip(cases, tokens.many(cases), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokens.whole.encode(text, add_special_tokens=False).ids


def check_packed(rows, sequence):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= sequence
    return len(places)


def test_packed_documents(docs, awkward, empty):
    rows = packing.packed_documents(docs).collect()
    bound = -(-sum(r.length for r in rows) // packing.SEQUENCE)
    assert check_packed(rows, packing.SEQUENCE) <= 1.02 * bound + 1
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
    odd = packing.packed_documents(awkward).collect()
    check_packed(odd, packing.SEQUENCE)
    assert [r.length for r in odd if r.doc_id == 1] == [1] and max(r.piece for r in odd if r.doc_id == 4) > 5
    assert packing.packed_documents(empty).count() == 0


def test_islands_and_migration(spark):
    rng = random.Random(4)
    sizes = [rng.randrange(1, 101) for _ in range(600)]
    pieces = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, length long")
    rows = packing.pack(pieces, sequence=100, island=60).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    big = sum(s > 50 for s in sizes)
    assert check_packed(rows, 100) <= max(-(-sum(sizes) // 100), big) * 1.06 + 1


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 60, 200)
    a = packing.Packing(sizes, 100).place(list(range(200)))
    b = packing.Packing(sizes, 100).place(list(range(199, -1, -1)))
    child = packing.crossover(a, b, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(200)) and max(child.fill) <= 100
    assert len(packing.evolve(sizes, 100, 1).bins) <= min(len(a.bins), len(b.bins))


# the pipeline


def test_stages_keep_columns_and_take_effect(spark, folder, docs, texts, tmp_path):
    stored = docs
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, stored, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        if name == "near_duplicates":
            known = {r.doc_id: r.text for r in stored.collect()}
            _, classes = brute_links(known)
            assert {r.doc_id for r in after.collect()} == set(classes.values())
        if name == "secrets":
            assert not any(brute_secrets(r.text) for r in after.collect())
        stored = after
    kept = {r.doc_id for r in stored.collect()}
    assert kept <= before and len(kept) > 0.3 * len(before)
    rows = corpus_pipeline.STAGES[-1][1](spark, stored, folder).collect()
    assert {r.doc_id for r in rows} == kept
    check_packed(rows, packing.SEQUENCE)


def test_stages_on_awkward_rows(spark, folder, awkward, tmp_path):
    stored = awkward
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, stored, folder).write.parquet(path)
        stored = spark.read.parquet(path)
        if name != "packing":
            assert stored.columns == awkward.columns
    check_packed(stored.collect(), packing.SEQUENCE)


def test_registered_names():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
