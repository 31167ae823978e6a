import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchloom.llm import components, near_dedup, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            common = len(sets[i] & sets[j])
            linked = common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common)
            if linked or (rows[i][0] == rows[j][0] and sets[i] and sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        c = None if doc is None else least[root(i)]
        out.append((doc, len(sets[i]), c, doc is None or doc == c))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [None, "", " \n\t", "One", "one", "a b c", "A  b\tc", "a b c d", "é x y z w", "É x y z w"]
    texts += [" ".join(word() for _ in range(20_000))] * 2
    for base in range(12):
        words = [word() for _ in range(rng.choice([12, 40, 150]))]
        for _ in range(12 if base else 60):  # the first makes a large bucket
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    # a chain: neighbours are alike, the ends are not
    chain = [word() for _ in range(100)]
    for step in range(25):
        texts.append(" ".join(chain[step * 2 :] + [f"c{i}" for i in range(step * 2)]))
    ids = list(range(1000, 1000 + len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    return rows + [(None, texts[20]), (None, texts[20]), rows[30], (ids[40], texts[60]), (ids[41], "other words of its own here now")]


def run(spark, rows, k, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x")).withColumn("sig", F.lit(1))
    got = near_dedup.report(docs, words=k, percent=percent)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("k", [4, 5])
def test_matches_brute_force(spark, k):
    rows = fixture()
    assert run(spark, rows, k) == brute(rows, k, 80)


def test_classes_of_crowded_buckets_all_meet(spark, monkeypatch):
    # one row for a band: much collides, and small blocks make many of them
    monkeypatch.setattr(near_dedup, "BANDS", 10)
    monkeypatch.setattr(near_dedup, "ROWS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SLACK", 0.3)
    monkeypatch.setattr(near_dedup, "MAX_BROADCAST_IDS", 0)
    rng = random.Random(2)
    pool = [f"v{i}" for i in range(14)]
    rows = [(i, " ".join(rng.sample(pool, 9))) for i in range(160)]
    assert run(spark, rows, 1, 70) == brute(rows, 1, 70)


def test_representatives_and_empty_tables(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", 1), (2, "A b c d e f", 2), (9, None, 3), (None, "a b c d e f", 4)], "doc_id long, text string, `x.y` int")
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns and {r[2] for r in kept.collect()} == {2, 3, 4}
    assert near_dedup.report(docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5), (7, None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    assert got == {x: root(x) for x in parent}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_hashes_are_the_same_everywhere():
    code = "from searchloom.llm import shingles; print(shingles.fingerprint(shingles.shingle_sets(['a b c d e f'], 3)[0]))"
    assert len({subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout for _ in range(2)}) == 1


def test_long_texts_are_cut_at_white_space_only(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000)) + "  " + "z" * 3000
    whole = shingles.shingle_sets([text], 4)[0]
    minima = shingles.minima([whole, whole[:7]], 6)
    monkeypatch.setattr(shingles, "PIECE", 100)
    monkeypatch.setattr(shingles, "SLICE", 50)
    assert (shingles.shingle_sets([text], 4)[0] == whole).all() and len(whole) == 4998
    assert (shingles.minima([whole, whole[:7]], 6) == minima).all()
    assert (np.diff(whole.astype(object)) > 0).all()
