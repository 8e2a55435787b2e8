"""License scan: ordered signature rules over normalised words, in column expressions only.

A text is read as its words (A-Z in lower case) joined by one blank.  Rules are
patterns over that form.  A rule runs only where its keyword occurs, and a text
without any keyword is not normalised at all.  Detections are intervals of
words; one that lies inside another of the same or a higher priority is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.llm.common import text_of

WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The phrases and labels that every scan reports.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    priority: int
    score: float
    pattern: str  # over words with a blank before each; ends before a blank


# label, keyword that every match holds, the name in words, its short identifier (once a license), and whether the
# bare name tells enough
_LICENSES = (
    ("mit", "mit", "mit(?: expat)?", "mit", False),
    ("mit-0", "mit", "mit no attribution", "mit 0", True),
    ("apache-2", "apache", "apache(?: software)?(?: license| licence)?(?: version| v)? ?2(?: 0)?", "apache 2 0", True),
    ("apache-1.1", "apache", "apache(?: software)?(?: license| licence)?(?: version| v)? ?1 1", "apache 1 1", True),
    ("gpl-3", "gpl", "(?:gnu )?gpl(?: version| v)? ?v?3(?: 0)?", "gpl 3 0(?: only| or later)?", True),
    ("gpl-3", "general public", "(?:gnu )?general public license(?: version| v)? ?v?3(?: 0)?", "", True),
    ("gpl-2", "gpl", "(?:gnu )?gpl(?: version| v)? ?v?2(?: 0)?", "gpl 2 0(?: only| or later)?", True),
    ("gpl-2", "general public", "(?:gnu )?general public license(?: version| v)? ?v?2(?: 0)?", "", True),
    ("gpl", "gpl", "gnu gpl", "gpl", True),
    ("gpl", "general public", "gnu general public license", "", True),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?v?3(?: 0)?", "lgpl 3 0(?: only| or later)?", True),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?v?3(?: 0)?", "", True),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?v?2 1", "lgpl 2 1(?: only| or later)?", True),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?v?2 1", "", True),
    ("lgpl", "general public", "gnu (?:lesser|library) general public license", "lgpl", True),
    ("agpl-3", "agpl", "(?:gnu )?agpl(?: version| v)? ?v?3(?: 0)?", "agpl 3 0(?: only| or later)?", True),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version| v)? ?v?3(?: 0)?", "", True),
    ("agpl", "affero", "gnu affero general public license", "agpl", True),
    ("fdl-1.3", "free", "(?:gnu )?free documentation license(?: version)? 1 3", "gfdl 1 3(?: only| or later)?", True),
    ("fdl", "free", "gnu free documentation license", "gfdl", True),
    ("bsd-2", "bsd", "(?:bsd 2 clause|simplified bsd|freebsd|2 clause bsd)", "bsd 2 clause", True),
    ("bsd-3", "bsd", "(?:bsd 3 clause|new bsd|modified bsd|revised bsd|3 clause bsd)", "bsd 3 clause", True),
    ("bsd-4", "bsd", "(?:bsd 4 clause|original bsd|4 clause bsd)", "bsd 4 clause", True),
    ("bsd-0", "bsd", "(?:zero clause bsd|0bsd|bsd zero clause)", "0bsd", True),
    ("bsd", "bsd", "bsd", "bsd", False),
    ("isc", "isc", "isc", "isc", False),
    ("mpl-2", "mpl", "mpl(?: version| v)? ?2(?: 0)?", "mpl 2 0", True),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?", "", True),
    ("mpl-1.1", "mpl", "mpl(?: version| v)? ?1 1", "mpl 1 1", True),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? ?1 1", "", True),
    ("epl-2", "epl", "epl(?: version| v)? ?2(?: 0)?", "epl 2 0", True),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?", "", True),
    ("epl-1", "epl", "epl(?: version| v)? ?1(?: 0)?", "epl 1 0", True),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?", "", True),
    ("cddl-1", "cddl", "cddl(?: version)?(?: 1(?: 0)?)?", "cddl 1 0", True),
    ("cddl-1", "common development", "common development and distribution license(?: version)?(?: 1(?: 0)?)?", "", True),
    ("cpl-1", "common", "common public license(?: version)?(?: 1(?: 0)?)?", "cpl 1 0", True),
    ("eupl-1.2", "eupl", "eupl(?: version| v)?(?: 1 2)?", "eupl 1 2", True),
    ("eupl-1.2", "european union", "european union public licen[cs]e(?: version| v)?(?: 1 2)?", "", True),
    ("artistic-2", "artistic", "(?:the )?artistic license(?: version)? 2(?: 0)?", "artistic 2 0", True),
    ("artistic-1", "artistic", "(?:the )?artistic license", "artistic 1 0", True),
    ("bsl-1", "boost", "boost software license(?: version)?(?: 1(?: 0)?)?", "bsl 1 0", True),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib", False),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", True),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", True),
    ("wtfpl", "do what the", "do what the fuck you want to public license", "", True),
    ("python-2", "python", "python software foundation license(?: version)?(?: 2)?", "psf 2 0", True),
    ("postgresql", "postgresql", "postgresql", "postgresql", False),
    ("openssl", "openssl", "openssl", "openssl", False),
    ("php-3", "php", "php license(?: version)? 3(?: 01?)?", "php 3 01", True),
    ("ruby", "ruby", "ruby", "ruby", False),
    ("ofl-1.1", "open font", "(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1", True),
    ("odbl-1", "open", "open database license(?: version| v)?(?: 1(?: 0)?)?", "odbl 1 0", True),
    ("odc-by-1", "open", "open data commons attribution license(?: v?1(?: 0)?)?", "odc by 1 0", True),
    ("pddl-1", "public", "public domain dedication and license(?: v?1(?: 0)?)?", "pddl 1 0", True),
    ("cc0-1", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0", True),
    ("cc-by-nc-nd", " cc ", "cc (?:by nc nd|attribution noncommercial noderiv\\w*)(?: \\d 0)?", "cc by nc nd \\d 0", True),
    ("cc-by-nc-nd", "creative commons", "creative commons (?:by nc nd|attribution noncommercial noderiv\\w*)(?: \\d 0)?", "", True),
    ("cc-by-nc-sa", " cc ", "cc (?:by nc sa|attribution noncommercial sharealike)(?: \\d 0)?", "cc by nc sa \\d 0", True),
    ("cc-by-nc-sa", "creative commons", "creative commons (?:by nc sa|attribution noncommercial sharealike)(?: \\d 0)?", "", True),
    ("cc-by-nc", " cc ", "cc (?:by nc|attribution non ?commercial)(?: \\d 0)?", "cc by nc \\d 0", True),
    ("cc-by-nc", "creative commons", "creative commons (?:by nc|attribution non ?commercial)(?: \\d 0)?", "", True),
    ("cc-by-nd", " cc ", "cc (?:by nd|attribution noderiv\\w*)(?: \\d 0)?", "cc by nd \\d 0", True),
    ("cc-by-nd", "creative commons", "creative commons (?:by nd|attribution noderiv\\w*)(?: \\d 0)?", "", True),
    ("cc-by-sa", " cc ", "cc (?:by sa|attribution share ?alike)(?: \\d 0)?", "cc by sa \\d 0", True),
    ("cc-by-sa", "creative commons", "creative commons (?:by sa|attribution share ?alike)(?: \\d 0)?", "", True),
    ("cc-by", "cc by", "cc by(?: \\d 0)?", "cc by \\d 0", True),
    ("cc-by", "creative commons", "creative commons attribution(?: \\d 0)?", "", True),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl", True),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl", True),
    ("ncsa", "illinois", "university of illinois(?: ncsa)?(?: open source)?", "ncsa", False),
    ("upl-1", "universal", "universal permissive license(?: v?1(?: 0)?)?", "upl 1 0", True),
    ("w3c", "w3c", "w3c(?: software)?", "w3c", False),
    ("x11", "x11", "x11", "x11", False),
    ("busl-1.1", "business", "business source license(?: 1 1)?", "busl 1 1", True),
    ("sspl-1", "sspl", "sspl(?: version| v)?(?: 1)?", "sspl 1 0", True),
    ("sspl-1", "server side", "server side public license(?: version| v)?(?: 1)?", "", True),
    ("elastic-2", "elastic", "elastic license(?: 2(?: 0)?)?", "elastic 2 0", True),
)
_OTHERS = (
    Rule("all-rights-reserved", "rights reserved", 2, 0.6, " all rights reserved"),
    Rule("all-rights-reserved", "copyright", 1, 0.3, " copyright(?: c)? (?:19|20)\\d\\d"),
    Rule("public-domain", "public domain", 3, 0.8, " (?:dedicated to|released into|placed in|is in) the public domain"),
    Rule("public-domain", "public domain", 1, 0.4, " public domain"),
    Rule("permissive-notice", "permission is hereby granted", 2, 0.7, " permission is hereby granted free of charge to any person"),
    Rule("proprietary", "proprietary", 2, 0.6, " (?:proprietary and confidential|confidential and proprietary|proprietary license)"),
    Rule("no-redistribution", "redistribut", 2, 0.6, " (?:may not be|must not be|do not) redistributed?"),
)


# Bodies of notices that name no license, or name its version apart.
_SOFTWARE = " gnu {kind} license(?: \\w+){{0,3}} as published by the free software foundation (?:either )?version {number}"
_BODIES = (
    Rule("mit", "permission is hereby granted", 4, 0.9, " permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule("bsd", "redistribution and use", 3, 0.85, " redistribution and use in source and binary forms"),
    Rule("bsd-3", "endorse or promote", 4, 0.9, " neither the name of(?: \\S+){1,20}? may be used to endorse or promote products"),
    Rule("isc", "permission to use copy", 4, 0.9, " permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    Rule("apache-2", "except in compliance", 4, 0.9, " you may not use this (?:file|software|work) except in compliance with the license"),
    *[
        Rule(f"{short}-{label}", kind, 5, 0.95, _SOFTWARE.format(kind=kind, number=number))
        for short, kind, label, number in (
            ("gpl", "general public", "3", "3"),
            ("gpl", "general public", "2", "2"),
            ("lgpl", "lesser general public", "3", "3"),
            ("lgpl", "lesser general public", "2.1", "2 1"),
            ("agpl", "affero general public", "3", "3"),
        )
    ],
)


def signature_rules() -> tuple[Rule, ...]:
    """Every license in its usual statements, in the order of precedence.

    A bare name that is also an ordinary word or the name of an institution counts
    only next to the word license: prose may well be published by such a name.
    """
    rules = []
    for label, keyword, name, short, plain in _LICENSES:
        end = "(?: licen[cs]e)?(?: version \\d(?: \\d)?)?"
        sure = " licen[cs]e(?: version \\d(?: \\d)?)?"
        terms = "(?: the)?(?: terms of)?(?: the)?(?: a)?"
        if short:
            rules.append(Rule(label, "spdx", 5, 1.0, f" spdx license identifier {short}"))
        if plain:
            stated = f" (?:(?:licen[cs]ed|released|distributed|available|published|provided) under|(?:covered|governed) (?:under|by)){terms} {name}{end}"
        else:
            stated = (
                f" (?:licen[cs]ed under{terms} {name}{end}"
                f"|(?:(?:released|distributed|available|published|provided) under|(?:covered|governed) (?:under|by)){terms} {name}{sure})"
            )
        rules += [
            Rule(label, keyword, 4, 0.95, stated),
            Rule(label, "licen", 3, 0.9, f" {name} licen[cs]ed?(?: version \\d(?: \\d)?)?"),
            Rule(label, "licen", 2, 0.8, f" licen[cs]e(?: type| name| is)?(?: the)? {name}"),
        ]
        if plain:
            rules.append(Rule(label, keyword, 1, 0.5, f" {name}"))
    return (*rules, *_BODIES, *_OTHERS)


# What every rule and phrase needs somewhere in the text; others are not normalised.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GATE = (
    r"(?i)licen[cs]|copyright|spdx|rights" + _GAP + r"reserved|public" + _GAP + r"domain|permission" + _GAP + r"(?:is|to" + _GAP + r"use)"
    r"|proprietary|redistribut|endorse" + _GAP + r"or" + _GAP + r"promote|creative" + _GAP + r"commons|cc" + _GAP + r"(?:by|attribution)|cc0|apache|gpl|mpl|epl|cddl|eupl|sspl|affero|wtfpl|0bsd|bsd"
    r"|(?:licensed|released|distributed|available|published|provided|covered|covers?|governed)" + _GAP + r"(?:under|by)"
    r"|public" + _GAP + r"licen|mit" + _GAP + r"no" + _GAP + r"attribution"
)


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def word_spans(normal: Column, pattern: Column) -> Column:
    """Intervals of words that match, left to right without overlap."""
    between, hits = F.split(normal, pattern, -1), F.regexp_extract_all(normal, pattern, F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(hits)).alias("gap"), hits.alias("hit")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + _blanks(x["gap"]) + _blanks(x["hit"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + _blanks(x["gap"])).alias("start"),
                        (acc["at"] + _blanks(x["gap"]) + _blanks(x["hit"])).alias("end"),
                    )
                ),
            ).alias("out"),
        ),
    )
    return F.when(F.size(hits) > 0, walked["out"]).otherwise(empty)


def _phrase_places(normal: Column, phrase: str, label: str) -> Column:
    spans = F.when(F.contains(normal, F.lit(f" {phrase} ")), word_spans(normal, F.lit(f" {phrase}(?= )"))).otherwise(
        F.array().cast("array<struct<start:int,end:int>>")
    )
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(label).alias("label")))


def _rules_literal(rules: tuple[Rule, ...]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("n"),
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.score).alias("score"),
                F.lit(r.pattern + "(?= )").alias("pattern"),
            )
            for n, r in enumerate(rules)
        ]
    )


_DETECTION = "struct<start:int,back:int,rank:int,n:int,end:int,priority:int,label:string,score:double>"


def _detections(normal: Column, rules: tuple[Rule, ...]) -> Column:
    """All rule matches, widest and most important first where they begin together."""
    gated = F.filter(_rules_literal(rules), lambda r: F.contains(normal, r["keyword"]))
    found = F.transform(
        gated,
        lambda r: F.transform(
            word_spans(normal, r["pattern"]),
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["end"]).alias("back"),
                (-r["priority"]).alias("rank"),
                r["n"].alias("n"),
                s["end"].alias("end"),
                r["priority"].alias("priority"),
                r["label"].alias("label"),
                r["score"].alias("score"),
            ),
        ),
    )
    return F.sort_array(F.flatten(found))


def _uncontained(found: Column, levels: int = 5) -> Column:
    """Without those inside another of the same or a higher priority; one pass over the sorted list.

    ``reach`` holds for each priority how far the kept ones of at least that
    priority extend.
    """
    return F.aggregate(
        found,
        F.struct(F.array_repeat(F.lit(-1), levels).alias("reach"), F.array().cast(f"array<{_DETECTION}>").alias("kept")),
        lambda acc, d: F.when(F.element_at(acc["reach"], d["priority"]) >= d["end"], acc).otherwise(
            F.struct(
                F.transform(
                    acc["reach"], lambda e, i: F.when(i < d["priority"], F.greatest(e, d["end"])).otherwise(e)
                ).alias("reach"),
                F.concat(acc["kept"], F.array(d)).alias("kept"),
            )
        ),
    )["kept"]


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] | None = None, text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base (phrase places) and detections, an array of (start, end, label, priority, score).

    Every row is judged on its own: repeated rows give repeated results, a null
    or empty text has no words and no detections, and texts of any length are
    read whole.  Other columns are not read.
    """
    rules = rules or signature_rules()
    text = F.col("__text")
    gated = docs.select("doc_id", text_of(text_col).alias("__text")).select(
        "doc_id",
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("n_words"),
        F.when(
            text.rlike(GATE),
            F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.translate(text, _CAPITALS, _SMALL), F.lit(WORDS), F.lit(0)), " "), F.lit(" ")),
        ).alias("__normal"),
    )
    normal = F.col("__normal")
    places = [_phrase_places(normal, phrase, label) for phrase, label in PHRASES]
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    return gated.select(
        "doc_id",
        "n_words",
        F.when(normal.isNull(), none).otherwise(F.concat(*places)).alias("base"),
        F.when(normal.isNull(), F.array().cast(f"array<{_DETECTION}>"))
        .otherwise(_uncontained(_detections(normal, rules)))
        .alias("__kept"),
    ).select(
        "doc_id",
        "n_words",
        "base",
        F.transform(
            "__kept",
            lambda d: F.struct(d["start"].alias("start"), d["end"].alias("end"), d["label"].alias("label"), d["priority"].alias("priority"), d["score"].alias("score")),
        ).alias("detections"),
    )


def license_digest(docs: DataFrame) -> DataFrame:
    """The scan's counts, places, labels and score, a row for each document.

    A null or empty text gives no words, null places, empty labels and score 0;
    repeated rows give repeated rows.
    """
    found = scan_licenses(docs)
    starts = F.transform("base", lambda b: b["start"])
    names = lambda column: F.transform(column, lambda b: b["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    scores = F.concat(F.transform("detections", lambda d: d["score"]), F.transform("base", lambda b: F.lit(0.9)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        joined(names("base")).alias("base_labels"),
        joined(F.concat(names("base"), names("detections"))).alias("labels"),
        F.coalesce(F.array_max(scores), F.lit(0.0)).alias("score"),
        F.size("detections").cast("bigint").alias("n_detections"),
    )
