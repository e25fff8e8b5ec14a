"""License scan against a plain search of word lists, and its edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from opinara.llm import licenses
from opinara.llm.licenses import GRANT, IDENTIFIER, NAME, RULES, Rule, spelled


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain(text, phrases=licenses.PHRASES, rules=RULES):
    """Word count, places by label and the detections that stay, pair by pair."""
    words = words_of(text)
    places = {}
    for phrase, label in phrases:
        wanted = phrase.split(" ")
        at = [i for i in range(len(words) - len(wanted) + 1) if words[i : i + len(wanted)] == wanted]
        if at:
            places[label] = (len(at), at[0], at[-1])
    padded = "".join(f" {w} " for w in words)
    found = []
    for rank, rule in enumerate(rules):
        if set(rule.keywords) <= set(words):
            for m in re.finditer(rule.pattern, padded):
                start = padded[: m.start()].count(" ") // 2
                found.append((start, start + m[0].count(" ") // 2, rule.priority, rank, rule.label))

    def stays(a):
        for b in found:
            if a is not b:
                inside = b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2]
                if inside and (b[:2] != a[:2] or b[2] > a[2] or b[3] < a[3]):
                    return False
                if b[2] > a[2] and b[0] < a[1] and a[0] < b[1]:
                    return False
        return True

    return len(words), places, sorted((s, e, label, p) for s, e, p, _, label in filter(stays, found))


def scanned(spark, texts, **how):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.licenses(rows, **how).orderBy("doc_id").collect()
    return [
        (r["n_words"], {p["label"]: (p["n"], p["first"], p["last"]) for p in r["places"]},
         sorted((d["start"], d["stop"], d["label"], d["priority"]) for d in r["found"]))
        for r in rows
    ]


TEXTS = [
    None, "", " \t\n", "...!", "a", "CC BY", "ccby cc-by cc_by CC  BY", "occ by cc bye",
    "Licensed under the Apache License, Version 2.0.", "submit license", "MIT License", "The ÉMIT license Émit",
    "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: MIT",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License v2.1 and GNU Affero General Public License",
    "under the terms of the GNU General Public License version 2 or (at your option) any later version",
    "Licensed under CC BY-NC 4.0. All rights reserved. ALL RIGHTS RESERVED",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "all rights all rights reserved general public license cc by cc by",
    "Copyright (c) 2019 2020 Someone. MIT License. BSD 3-Clause License; new BSD license, zlib license",
    "https://creativecommons.org/licenses/by-sa/4.0/ Creative Commons Attribution-ShareAlike 4.0 International License",
]


def test_against_plain_search(spark):
    assert scanned(spark, TEXTS) == [plain(t) for t in TEXTS]


def test_long_text_with_many_detections(spark):
    text = "x MIT License y. Released under the Apache License, Version 2.0 z! all rights reserved, " * 700
    small, large = scanned(spark, [text[: len(text) // 70], text])
    assert small == plain(text[: len(text) // 70])
    assert large[0] == 16 * 700 and large[1] == {"reserved": (700, 13, 16 * 699 + 13)} and len(large[2]) == 1400


def test_own_rules_overlap_by_priority(spark):
    rules = [
        Rule("wide", ("a",), NAME, spelled("a b c d")), Rule("high", ("d",), GRANT, spelled("d e")), Rule("inner", ("b",), NAME, spelled("b c")),
        Rule("same", ("b",), NAME, spelled("b c")), Rule("top", ("e",), IDENTIFIER, spelled("e f g")), Rule("low", ("x",), NAME, spelled("x y z")),
    ]
    texts = ["a b c d", "a b c d e", "a b c d e f g", "b c", "x y z", "d e", "z a b c d x y z d e", "f b c b c"]
    assert scanned(spark, texts, wanted=rules) == [plain(t, rules=rules) for t in texts]
    assert [x[2] for x in scanned(spark, ["b c"], wanted=rules)[0][2]] == ["inner"]


def test_overlapping_places_all_count(spark):
    phrases = (("a b a", "aba"), ("a", "one"))
    texts = ["a b a b a", "a b a a b a", "b"]
    assert scanned(spark, texts, phrases=phrases, wanted=[]) == [plain(t, phrases, []) for t in texts]


def test_rows_and_columns(spark):
    rows = spark.createDataFrame([(None, "MIT License", 1, "p", "f"), (3, "cc by", 2, "p", "f"), (3, "cc by", 2, "p", "f")], "doc_id long, text string, _id int, _padded string, found string")
    out = licenses.licenses(rows)
    assert out.columns == ["doc_id", "n_words", "places", "found"]
    got = sorted((r["doc_id"] or 0, r["n_words"], len(r["places"]), len(r["found"])) for r in out.collect())
    assert got == [(0, 2, 0, 1), (3, 2, 1, 0), (3, 2, 1, 0)]
    assert licenses.licenses(rows.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.licenses(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_there_are_hundreds_of_rules():
    assert len(RULES) > 250 and len({(r.label, r.pattern) for r in RULES}) == len(RULES)
    with pytest.raises(AttributeError):
        RULES[0].label = "x"
