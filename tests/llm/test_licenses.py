import random
import re

import pytest

from rallybook.llm.licenses import DECIDING, OPTIONAL, PERCENT, TEMPLATES, license_matches


def grams(words):
    return set(zip(words, words[1:]))


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def brute_force(text):
    """All (license, place) whose window holds the template and its deciding words, for texts with lone
    passages."""
    w = words(text)
    out = set()
    for name, template in TEMPLATES:
        t = words(template)
        own = deciding(t)
        for i in range(len(w)):
            window = w[i : i + len(t)]
            enough = 100 * len(grams(t) & grams(window)) >= PERCENT * len(grams(t))
            if enough and deciding(window) <= own and own - set(OPTIONAL) <= deciding(window):
                out.add((name, i, t[0]))
    return out


def deciding(words):
    return {w for w in words if w in DECIDING or re.fullmatch("[0-9]+", w)}


CC = "This work is licensed under a Creative Commons {} 4.0 International License"
GNU = "You should have received a copy of the GNU {} along with this {}"


@pytest.mark.parametrize(
    "text, names",
    [
        (CC.format("Attribution"), {"CC-BY-4.0"}),
        (CC.format("Attribution-ShareAlike"), {"CC-BY-SA-4.0"}),
        (CC.format("Attribution-NonCommercial"), {"CC-BY-NC-4.0"}),
        (CC.format("Attribution-NonCommercial-NoDerivatives"), {"CC-BY-NC-ND-4.0"}),
        (CC.format("Attribution").replace("4.0 International", "2.5 Generic"), set()),
        ("Licensed under CC BY-NC-SA 4.0, see below", {"CC-BY-NC-SA-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under the GNU General Public License, version 3 or later.", {"GPL-3.0"}),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", {"LGPL-3.0"}),
        (GNU.format("General Public License", "program"), {"GPL"}),
        (GNU.format("Lesser General Public License", "program"), {"LGPL"}),
        (GNU.format("Affero General Public License", "program"), {"AGPL"}),
        ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License)", {"MPL-1.1"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"MPL-2.0"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", set()),
        ("Licensed under the Apache License, Version 2", {"Apache-2.0"}),
        ("Licensed under the Apache License, Version 1.1", set()),
        # A text that is most of a notice, and one that breaks off.
        ("copy of the GNU General Public License along with this program", set()),
        ("should have received a copy of the GNU General Public License along with this", {"GPL"}),
        ("of this text: Permission is hereby granted, free of charge, to any person obtaining a copy of this software and", {"MIT"}),
    ],
)
def test_licenses_of_one_family_are_told_apart(spark, text, names):
    rows = [(1, text), (2, "some words before. " + text), (3, "in 2020, 7 words after " + text + " and 12 more words")]
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        # What breaks off at the end of a text does so there only.
        if r.doc_id < 3 or "person" not in text:
            assert {m.license for m in r.matches} == names, (r.doc_id, r.matches)


def test_long_texts_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    long = "word " * 300_000 + TEMPLATES[0][1] + " " + "x" * 1_000_000
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    rows = license_matches(docs.withColumns({c: F.lit(1) for c in ("matches", "license", "word")})).collect()
    assert {r.doc_id: [(m.license, m.word) for m in r.matches] for r in rows} == {1: [("AGPL", 300_000)], 2: []}


def test_whole_changed_and_missing_passages(spark):
    rng = random.Random(3)
    filler = [rng.choice("lorem ipsum dolor sit amet é 12".split()) for _ in range(3000)]
    rows = [(0, None), (1, ""), (2, " ".join(filler)), (None, TEMPLATES[0][1]), (3, "license"), (3, "license")]
    for i, (_, template) in enumerate(TEMPLATES):
        parts = template.split()
        middle = parts[: len(parts) // 2] + ["changed"] + parts[len(parts) // 2 + 1 :]
        rows.append((100 + i, " ".join([*filler[: 40 * i], template.upper(), *filler[:7]])))
        rows.append((200 + i, " ".join([*filler[:9], *(middle if len(parts) > 12 else parts)])))
        rows.append((300 + i, " ".join(parts[: len(parts) // 2])))
    got = {}
    for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append({(m.license, m.word) for m in r.matches})
    for doc, text in rows:
        exact = {(n, i) for n, i, _ in brute_force(text or "")}
        for found in got[doc]:
            # Windows that overlap a better one are not reported apart.
            assert found <= exact
            assert {n for n, _ in found} == {n for n, _ in exact}, doc
    assert len(got[3]) == 2


def test_empty_table_and_passages_across_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert license_matches(docs).count() == 0
    split = [(1, "Licensed under the Apache"), (2, "License, Version 2.0.")]
    rows = license_matches(spark.createDataFrame(split, "doc_id long, text string").coalesce(1)).collect()
    assert all(not r.matches for r in rows)
