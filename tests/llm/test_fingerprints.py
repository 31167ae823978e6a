import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from searchloom.llm import fingerprints as FP

MASK = 2**64 - 1


def chained(*parts):
    """The hash of several columns: each seeds the next."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


def i32(x):
    return struct.pack("<i", x)


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [struct.pack("<Q", chained(w)) for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)]
    if not words:
        return set()
    k = min(5, len(words))
    return {chained(*words[i : i + k]) >> 1 for i in range(len(words) - k + 1)}


def brute(text):
    """The fingerprint as hexadecimal digits, bin by bin."""
    least = {}
    for v in shingles(text):
        b = v >> FP.BIN_SHIFT
        least[b] = min(v, least.get(b, v))
    if not least:
        return ""
    out = []
    for k in range(FP.BINS):
        walk = [k] + [chained(i32(k), i32(t)) & (FP.BINS - 1) for t in range(FP.STEPS)]
        signed = lambda b: (h := chained(i32(k), i32(FP.STEPS), i32(b))) - (h >> 63 << 64)  # noqa: E731, B023
        found = next((b for b in walk if b in least), None)
        out.append(least[min(least, key=signed) if found is None else found])
    return "".join(f"{v & 15:x}" for v in out)


def near(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = sum(x == y for x, y in zip(a, b)) / FP.BINS
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def expected(rows):
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda r: (r[0], r[1], *(h - (h >> 63 << 64) for h in (chained(r[2]), chained(i32(1), r[2])))))
    after = {r: order[(n + 1) % len(order)] for n, r in enumerate(order)}
    out = []
    for i, t in rows:
        own = t or ""
        other = after[(i is not None, i or 0, own)][2]
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        a, b, c = brute(own), brute(edited), brute(other)
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(near(a, b), 9), round(near(a, c), 9)))
    return sorted(out, key=str)


def texts(n=60):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinsÉß漢𝒳") for _ in range(rng.randrange(1, 7)))
    rows = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 4, 5, 6, 30, 200, 900])))) for i in rng.sample(range(1000), n)]
    base = rows[0][1]
    rows += [(2000, base), (2001, base + " more"), (2002, None), (2003, ""), (2004, " \n\t"), (2005, "One  Two\nthree FOUR five six"), (2006, "one two three four five six")]
    # ids that are there twice, with equal and with other texts, or not at all
    return rows + [(2000, base), (2001, "other text under the same id"), (None, "no id"), (None, base), (None, "no id")]


def test_matches_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)).withColumn("id", F.lit(2)).withColumn("a.b", F.lit(3)).repartition(5)
    got = FP.report(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got.collect()), key=str)
    assert found == expected(rows)


def test_one_document_and_none(spark):
    one = FP.report(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(1, hashlib.sha256(b"abcabc").hexdigest(), 1.0)]
    none = FP.report(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == [] and none.columns[-1] == "near_next"


def test_likeness_follows_similarity(spark):
    rng, rows = random.Random(7), []
    for i in range(240):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([120, 400, 2000]))]
        cut = int(len(words) * rng.random())
        rows.append((i, " ".join(words), " ".join(words[:cut] + [f"x{rng.randrange(10**6)}" for _ in range(len(words) - cut)])))
    pairs = spark.createDataFrame(rows, "i int, a string, b string")
    pairs = pairs.select("i", FP.fingerprint(F.col("a")).alias("a"), FP.fingerprint(F.col("b")).alias("b"))
    got = {r.i: r.near for r in pairs.select("i", FP.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    errors = []
    for i, a, b in rows:
        x, y = shingles(a), shingles(b)
        errors.append(got[i] - len(x & y) / len(x | y))
    assert abs(sum(errors)) / len(errors) < 0.01 and max(map(abs, errors)) < 0.15
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.04


def test_columns_are_carried_along(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6), (None, None, 7, 8)], "doc_id long, text string, doc int, `a.b` int")
    got = FP.fingerprints(docs)
    assert got.columns == [*docs.columns, "fingerprint"]
    assert sorted((r.doc, len(r.fingerprint)) for r in got.collect()) == [(5, 128), (7, 0)]


@pytest.mark.parametrize("n", [200_000])
def test_long_texts(spark, n):
    text = " ".join(f"w{i % 5000}x{i // 7}" for i in range(n))
    got = spark.createDataFrame([(text,)], "text string").select(FP.fingerprint(F.col("text")).alias("m")).first()
    assert got.m.hex() == brute(text)
