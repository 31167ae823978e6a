import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from searchloom.llm import licenses
from searchloom.llm.license_texts import CALLED, FORMS, TEMPLATES, all_templates


def grams(text):
    words = re.findall(r"\w+", text.lower())
    return Counter(zip(words, words[1:]))


def brute(text, templates, threshold=0.9):
    """Templates that some run of whole lines matches: every run is tried."""
    lines, found = (text or "").split("\n"), set()
    for a in range(len(lines)):
        for b in range(a + 1, len(lines) + 1):
            part = grams("\n".join(lines[a:b]))
            for name, template in templates:
                g = grams(template)
                if 2 * (part & g).total() >= threshold * (part.total() + g.total()):
                    found.add(name)
    return found


def test_finds_what_every_run_of_lines_finds(spark):
    rng = random.Random(12)
    prose = lambda: " ".join(rng.choice(["the", "software", "is", "provided", "of", "any", "walk", "tree", "license", "version"]) for _ in range(rng.randrange(1, 14)))
    texts = [None, "", "All", "all rights\nreserved", "ALL RIGHTS RESERVED!", "x " * 100_000]
    for name, template in TEMPLATES.items():
        words = template.split(" ")
        changed = list(words)
        if len(words) > 30:
            changed[rng.randrange(len(words))] = "Company"
        texts += ["\n".join([prose(), prose(), " ".join(changed), "", prose()]), template.upper(), f"{prose()}\n\n{template}\n{prose()}"]
    rows = list(enumerate(texts)) + [(None, TEMPLATES["mit"]), (4, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("parts", F.lit(1))
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.licenses == "mit"
        elif len(texts[r.doc_id] or "") < 5000:
            mine, want = set(r.licenses.split(",")) - {""}, brute(texts[r.doc_id], all_templates())
            # of overlapping matches only the best is reported
            assert mine <= want and bool(mine) == bool(want), (texts[r.doc_id], mine, want)
            assert (r.n_found > 0) == bool(mine) == (r.best_dice >= 0.9)
    at = 6 + 3 * list(TEMPLATES).index("mit-full")
    assert all(r.licenses == "mit-full" for r in got if r.doc_id in (at, at + 1, at + 2))
    assert licenses.scan(docs.limit(0)).collect() == []


def test_size_bounds_lose_nothing():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (Counter(rng.choices("abcdefgh", k=rng.randrange(1, 30))) for _ in range(2))
        low, high = 0.9 / 1.1, 1.1 / 0.9
        if licenses.dice(a, b) >= 0.9:
            assert b.total() * low <= a.total() <= b.total() * high


def test_embedded_and_repeated_notices():
    scan, mit = licenses.Scanner(TEMPLATES).scan, TEMPLATES["mit-full"].replace("\n", " ")
    parts = lambda text: [x[:3] for x in scan(text)]
    assert parts("Copyright 2020 Acme Inc. All rights reserved. Contact us.") == [("all-rights-reserved", 0, 1)]
    assert parts("All rights reserved.\nAll rights reserved.") == [("all-rights-reserved", 0, 1), ("all-rights-reserved", 1, 2)]
    assert parts("All rights reserved.\n\nAll rights reserved. " * 2) == [("all-rights-reserved", *x) for x in ((0, 1), (2, 3), (2, 3), (4, 5))]
    assert parts(f"some words before it {mit} and some words after it, all in one line") == [("mit-full", 0, 1)]
    assert parts(f"{TEMPLATES['mit-full']}\n\n{TEMPLATES['mit-full']}") == [("mit-full", 0, 10), ("mit-full", 11, 21)]
    assert parts("all rights are reserved, and the software is provided") == []
    assert parts(TEMPLATES["apache-2.0-header"].replace("governing", "that governs")) == [("apache-2.0-header", 0, 5)]


def test_windows_match_brute_force():
    rng = random.Random(6)
    templates = {"a": "p q r s t u v w x y z p q", "b": "p q r", "c": "q q q q p p"}
    for _ in range(400):
        words = [rng.choice("pqrstuvwxyz!") for _ in range(rng.randrange(12))] + rng.choice(list(templates.values())).split() * rng.randrange(3)
        at = rng.randrange(len(words) + 1)
        text = " ".join(words[:at] + [rng.choice(["n", "\n", "q"])] + words[at:])
        words = re.findall(r"\w+", text)
        want = {n for n, t in templates.items() for i in range(len(words)) for j in range(i + 2, len(words) + 1) if licenses.dice(grams(" ".join(words[i:j])), grams(t)) >= 0.9}
        got = {x[0] for x in licenses.Scanner(templates).scan(text)}
        assert got <= want and bool(got) == bool(want), text


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("Licensed under the MIT License.", "mit"),
        ("The code is licensed under MIT, the data are not.", "mit"),
        ("Licensed under CC BY 4.0.", "cc-by-4.0"),
        ("This text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"),
        ("Licensed under the Apache License 2.0", "apache-2.0"),
        ("# SPDX-License-Identifier: MIT", "mit"),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0"),
        ("Distributed under the GNU Lesser General Public License, version 2.1 or later", "lgpl-2.1"),
        ("You may use it under the terms of the GNU General Public License.", "gpl"),
        ("released under the BSD\n3-Clause License", "bsd-3-clause"),
    ],
)
def test_notices(text, name):
    assert [x[0] for x in licenses.Scanner(all_templates()).scan(f"Some words first. {text} And more.")] == [name]


def test_every_template_is_found_as_itself():
    scanner = licenses.Scanner(all_templates())
    for name, text in all_templates():
        assert name in [x[0] for x in scanner.scan(text)], (name, text)
    headers = [n for n in TEMPLATES if n.endswith("-header")]
    assert {scanner.scan(TEMPLATES[n])[0][0] for n in headers} == set(headers) and len({TEMPLATES[n] for n in headers}) == len(headers)
    assert "Affero" in TEMPLATES["agpl-3.0-header"] and TEMPLATES["lgpl-2.1-header"].count("Lesser") >= 2 and "Neither the name" in TEMPLATES["bsd-3-clause"]
    for text in ("the software is licensed", "under the terms of the contract", "available under the counter", "we licensed under a deal"):
        assert scanner.scan(text) == []
    assert len(FORMS) * sum(map(len, CALLED.values())) < len(all_templates())


def test_templates_of_a_table(spark, monkeypatch):
    table = spark.createDataFrame([("x", "one two three", 1), ("x", "three two one", 2), ("y", None, 3), (None, "a b", 4), ("x", "one two three", 5), ("z", "lone", 6)], "name string, text string, id int")
    docs = spark.createDataFrame([(1, "so one two three"), (2, "three, two; one"), (3, "lone a b")], "doc_id int, text string")
    got = {r.doc_id: (r.licenses, r.n_found) for r in licenses.scan(docs, templates=table).collect()}
    assert got == {1: ("x", 1), 2: ("x", 1), 3: ("", 0)}
    assert [r.n_found for r in licenses.scan(docs, templates=table.limit(0)).collect()] == [0, 0, 0]
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_BYTES", 10)
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=table)
