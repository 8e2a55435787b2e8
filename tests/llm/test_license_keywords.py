"""No prefilter of the license scan stands between a rule and its own matches."""

import re
from itertools import product

import pytest

from parcelight.llm import common, license_scan
from tests.llm.test_text_operators import by_id, frame


def samples(pattern):
    """A string for each way through the alternatives and optional parts of a pattern."""

    def ways(items):
        return ["".join(p) for p in product(*[way(op, value) for op, value in items])]

    def way(op, value):
        match str(op):
            case "LITERAL":
                return [chr(value)]
            case "IN":
                first = value[0]
                return ["1"] if str(first[1]) == "CATEGORY_DIGIT" else ["ative"] if str(first[1]) == "CATEGORY_WORD" else [chr(v) for _, v in value]
            case "BRANCH":
                return [s for branch in value[1] for s in ways(branch)]
            case "SUBPATTERN":
                return ways(value[3])
            case "MAX_REPEAT":
                low, high, inner = value
                return [*([""] if low == 0 and high == 1 else []), *ways(inner)]
        raise AssertionError(op)

    return ways(re._parser.parse(pattern))


def test_samples():
    assert samples(r"a(?: b|c)? [de]\d\w*") == ["a d1ative", "a e1ative", "a b d1ative", "a b e1ative", "ac d1ative", "ac e1ative"]


def bare_names():
    for label, keyword, name, _, plain in license_scan._LICENSES:
        yield from ((label, keyword, s, plain) for s in samples(name))
    for rule in license_scan._OTHERS:
        yield from ((rule.label, rule.keyword, s.strip(), True) for s in samples(rule.pattern))


def test_every_alternative_holds_its_keyword():
    # the longer rules of a license hold its name, or ask for a word of their own that they spell out
    missing = [(label, keyword, s) for label, keyword, s, _ in bare_names() if keyword not in f" {s} "]
    assert not missing
    assert all(len(r.keyword) >= 3 for r in license_scan.signature_rules())
    spelled = {"spdx": " spdx license identifier ", "licen": " licen[cs]e"}
    assert all(spelled.get(r.keyword, "") in r.pattern for r in license_scan.signature_rules())


def test_every_alternative_passes_the_gate():
    assert not [s for _, _, s, plain in bare_names() if plain and not re.search(license_scan.GATE, s)]


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa"),
        ("Creative Commons Attribution-NoDerivatives 4.0 International", "cc-by-nd"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
        ("Creative Commons: Attribution, NonCommercial, NoDerivs", "cc-by-nc-nd"),
        ("CC Attribution-ShareAlike 4.0", "cc-by-sa"),
        ("Do What The Fuck You Want To Public License", "wtfpl"),
        ("released under the Do What the Fuck You Want to Public License", "wtfpl"),
    ],
)
def test_names_without_the_short_form(spark, text, label):
    common.prepared(spark)
    found = by_id(license_scan.license_digest(frame(spark, [(1, text, "en", "a")])))
    assert found[1].labels == label


PROSE = [
    "The volume was published by MIT Press in 1999.", "provided by Ruby, our support lead", "The talk is covered by W3C news.",
    "Lunch is provided by ISC and distributed by X11 volunteers.", "Her ruby was available under the counter.",
]
BODIES = [
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Neither the name of the Foo Project nor the names of its contributors may be used to endorse or promote products", "bsd-3"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("you may not use this file except in compliance with the License.", "apache-2"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gpl-3"),
    ("the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl-2.1"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under MIT.", "mit"),
    ("released under the MIT License", "mit"),
    ("available under the GPL v3", "gpl-3"),
]


def test_prose_has_no_label_and_notices_have_theirs(spark):
    common.prepared(spark)
    rows = [(n, t, "en", "a") for n, t in enumerate([*PROSE, *[t for t, _ in BODIES]])]
    found = by_id(license_scan.license_digest(frame(spark, rows)))
    assert [found[n].labels for n in range(len(PROSE))] == [""] * len(PROSE)
    assert [found[n + len(PROSE)].labels for n in range(len(BODIES))] == [label for _, label in BODIES]


def brute_detections(text):
    """(start, end, label, priority) by Python's patterns over all rules, without keywords or gate."""
    words = re.findall(license_scan.WORDS, text.translate(str.maketrans(license_scan._CAPITALS, license_scan._SMALL)))
    normal = " " + " ".join(words) + " "
    found = []
    for n, r in enumerate(license_scan.signature_rules()):
        for m in re.finditer(r.pattern + "(?= )", normal, re.A):
            start = normal[: m.start()].count(" ")
            found.append((start, -(start + m.group().count(" ")), -r.priority, n, r.label))
    kept = []
    for start, back, rank, _, label in sorted(found):
        if not any(b <= back and k <= rank for _, b, k, _ in kept):
            kept.append((start, back, rank, label))
    return [(start, -back, label, -rank) for start, back, rank, label in kept]


def test_detections_are_those_of_a_plain_scan(spark):
    common.prepared(spark)
    names = [s for _, _, s, _ in bare_names()][::5]
    texts = [t for t, _ in BODIES] + PROSE + [
        f"x {a} and it is licensed under the terms of the {b} license version 2 0, {c} licensed" for a, b, c in zip(names, names[3:], names[7:])
    ]
    rows = license_scan.scan_licenses(frame(spark, [(n, t, "en", "a") for n, t in enumerate(texts)])).collect()
    for r in rows:
        got = [(d.start, d.end, d.label, d.priority) for d in r.detections]
        assert got == brute_detections(texts[r.doc_id]), texts[r.doc_id]
