import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from searchloom.llm import mixing


def fit(cells, goals, rounds=300):
    w = {c: float(t) for c, t in cells.items() if t > 0 and all(goals[k].get(c[k], 0) > 0 for k in range(3))}
    for _ in range(rounds):
        for k in range(3):
            sums = defaultdict(float)
            for c, x in w.items():
                sums[c[k]] += x
            w = {c: x * goals[k][c[k]] / sums[c[k]] for c, x in w.items()}
    return w


def rows():
    rng = random.Random(6)
    texts = ["plain words " * 9, "a | b", "x@y.z w", "under a licence; licensed", "l\n" * 30, "", None]
    return [(i, texts[rng.randrange(7)] and texts[rng.randrange(6)] * rng.randrange(4), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s1", "s2"])) for i in range(300)]


def test_matches_fitting_by_hand(spark):
    data = rows() + [(None, "no id here", "en", "s1"), (None, None, None, None), (5, "again", "en", "s0")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").withColumn("topic", F.lit("clash")).withColumn("w", F.lit(0))
    got = mixing.report(docs, fraction=0.5).collect()
    assert len(got) == len(data)
    cells = defaultdict(int)
    for r in got:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    goals = []
    for k in range(3):
        sums = defaultdict(int)
        for c, t in cells.items():
            sums[c[k]] += t
        powers = {v: t**mixing.TEMPERATURE for v, t in sums.items() if t}
        goals.append({v: p / sum(powers.values()) for v, p in powers.items()})
    w, total = fit(cells, goals), sum(cells.values())
    for r in got:
        c = r.source, r.lang, r.topic
        rate = w.get(c, 0.0) * total * 0.5 / cells[c] if cells[c] else 1.0
        assert r.probability == pytest.approx(min(1, rate), abs=2e-6) and r.weight == pytest.approx(max(1, rate), abs=2e-6)
        if r.doc_id is not None:
            u = int(hashlib.sha256(f"mix:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
            assert r.kept == (u < min(1, rate))
    by_id = {(r[0], r[1], r[2]): r for r in data}
    kept = mixing.sampled(docs, fraction=0.5)
    assert kept.columns == docs.columns
    want = sorted(((r.doc_id, r.n_tokens) for r in got if r.kept), key=str)
    assert sorted(((r.doc_id, len((r.text or "").split())) for r in kept.collect()), key=str) == want and by_id


def test_given_targets(spark):
    data = [(i, "w " * 10, "en" if i % 3 else "de", "a" if i % 2 else "b") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    shares = [("source", "a", 3.0), ("source", "b", 1.0), ("source", "absent", 4.0), ("lang", "en", 0.5), ("lang", "de", 0.5), ("topic", "prose", 1.0)]
    got = mixing.report(docs, targets=spark.createDataFrame(shares, "dimension string, value string, share double"), fraction=0.5).collect()
    mass = defaultdict(float)
    for r in got:
        mass[r.source] += r.probability * r.weight * r.n_tokens
        mass[r.lang] += r.probability * r.weight * r.n_tokens
    assert mass["a"] == pytest.approx(1500, rel=1e-3) and mass["en"] == pytest.approx(1000, rel=1e-3)
    # a value without a share gets nothing
    only = spark.createDataFrame([("source", "a", 1.0), ("lang", "en", 1.0), ("topic", "prose", 1.0)], "dimension string, value string, share double")
    assert {(r.source, r.lang) for r in mixing.report(docs, targets=only).where("kept").collect()} == {("a", "en")}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.report(docs).collect() == [] and mixing.sampled(docs).collect() == []
