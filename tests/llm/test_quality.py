import random
import re
from collections import Counter

from pyspark.sql import functions as F

from searchloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dups, len(covered), failed


def texts():
    rng = random.Random(3)
    yield from (None, "", " \n\t", "a\n a\na\n\na", "a a a a", "x y z x y z", "é\x85ü\xa0ß \x1c w", "ab | cd " * 40)
    for n in (10, 60, 200):
        for vocabulary in (3, 40, 5000):
            yield "".join(f"{rng.choice('abcdé')}{rng.randrange(vocabulary)}{rng.choice([' ', '  ', chr(10), ' é ', chr(9)])}" for _ in range(n))
    yield "word " * 50_000


def test_base_matches_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).withColumn("_m", F.lit(1))
    got = quality.report(docs).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted(found, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.report(docs.limit(0)).collect() == []


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 8), (5, 8), (6, 2)], "doc_id long, fail_bits long")
    policy = quality.Policy.of("t", "few_words", "symbols")
    assert {r.doc_id for r in quality.apply_policy(rows, policy).where("kept").collect()} == {1, 6}
    table = {r.rule: (r.fails, r.alone, r.kept_without) for r in quality.ablations(rows, policy).collect()}
    assert table == {"few_words": (2, 2, 4), "symbols": (2, 2, 4)}
    assert {r.rule: r.fails for r in quality.ablations(rows.limit(0), policy).collect()} == {"few_words": 0, "symbols": 0}


def test_passing_keeps_rows_as_they_are(spark):
    good = " ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    docs = spark.createDataFrame([(1, good, None), (2, "short", "x"), (1, good, "y"), (None, None, "z")], "doc_id long, text string, `_row.a` string")
    assert sorted(map(tuple, quality.passing(docs).collect()), key=str) == sorted([(1, good, None), (1, good, "y")], key=str)
    assert quality.passing(docs).columns == docs.columns
