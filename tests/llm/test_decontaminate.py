import hashlib
import random
import re

from pyspark.sql import functions as F

from searchloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    mine, hit, found = words(text), set(), set()
    for item, content in items:
        w = words(content)
        n = min(10, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(mine) - n + 1):
            if grams and tuple(mine[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(mine), len(hit), len(found), digest, bool(hit)


def fixture():
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "Of", "ÉA", "éa", "x1", "ab"]) + str(rng.randrange(6))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 9, 10, 11, 40])))) for i in range(30)]
    items += [(30, None), (31, " .. "), (None, "no id at all"), (32, items[3][1]), (2, items[3][1])]
    texts = [None, "", "...", "no id at all", "b" * 30_000]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(3)]
        inserted = rng.choice(items)[1] or ""
        texts.append("\n".join([parts[0], inserted.upper() if rng.random() < 0.3 else inserted.replace(" ", ", "), *parts[1:]]))
    return items, list(enumerate(texts)) + [(None, texts[7]), (7, texts[7]), (7, texts[8])]


def test_matches_brute_force(spark):
    items, rows = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit("x")).withColumn("n", F.lit(1)).withColumn("gram", F.lit(1))
    want = sorted(((i, *brute(t, items)) for i, t in rows), key=str)
    got = decontaminate.report(docs, benchmark).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_a_benchmark_beyond_the_broadcast_limit(spark, monkeypatch):
    items, rows = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit("x")).withColumn("places", F.lit(1)).withColumn("row", F.lit(1))
    want = sorted(map(tuple, decontaminate.report(docs, benchmark).collect()), key=str)
    clean = sorted(map(tuple, decontaminate.clean_documents(docs, benchmark).collect()), key=str)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", 0)
    assert sorted(map(tuple, decontaminate.report(docs, benchmark).collect()), key=str) == want
    assert sorted(map(tuple, decontaminate.clean_documents(docs, benchmark).collect()), key=str) == clean
    assert decontaminate.report(docs.limit(0), benchmark).collect() == []
    # what is shuffled for every word holds no words
    windows = decontaminate.benchmark_windows(benchmark)
    written = docs.select(decontaminate.words_of("text").alias("words"), F.monotonically_increasing_id().alias("row"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = decontaminate.key_places(written, windows, [1, 10])
        assert near.columns == ["key", "row", "start", "n"]
        plan = near._jdf.queryExecution().executedPlan().toString().split("\n")
        at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(key" in line)
        above = [line for line in plan[:at] if "words" in line]
        assert not above and "Generate inline" in "\n".join(plan[at:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_documents_and_spans_go(spark):
    items, rows = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("a.b", F.lit(1)).withColumn("kept", F.lit(2))
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(((i, t) for i, t in rows if not brute(t, items)[4]), key=str)
    cut = decontaminate.without_spans(docs, benchmark).collect()
    assert len(cut) == len(rows)
    one = decontaminate.without_spans(spark.createDataFrame([(1, "A, b-c. 1 2 3 4 5 6 7 8 9 10; d")], "doc_id long, text string"), spark.createDataFrame([(1, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string"))
    assert one.first().text == "A, b-c.          ; d"


def test_empty_tables(spark):
    items, rows = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert decontaminate.report(docs.limit(0), benchmark).collect() == []
    got = decontaminate.report(docs, benchmark.limit(0)).collect()
    assert len(got) == len(rows) and not any(r.contaminated for r in got)
    assert decontaminate.clean_documents(docs, benchmark.limit(0)).count() == len(rows)
