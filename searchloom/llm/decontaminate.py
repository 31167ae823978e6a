"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Benchmark items become windows of ``n`` words. Documents are cut into words once; every window
start gets a 64-bit key of four of its words, keys are looked up in the broadcast table, and the
few hits are verified on all words of the window. Documents are not shuffled: only hits and one
row per document are. A benchmark whose windows are too large to broadcast is met by keys alone:
(row, place, key) of every word is shuffled, without texts; the documents are written first, so that rows keep
their numbers, and get back the places whose key occurs.

Defined cases: a null or wordless text has no words and no hits. An item of fewer than ``n``
words, but not none, is one shorter window. An item without id still marks words, but is not
listed or counted among the items. Rows are judged one by one, so repeated rows and rows without
id give one result each. An empty benchmark or empty documents give no hits or no rows. Only the
named columns are read, whatever other columns are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm.texts import ASCII_GAPS, CASED_GAPS, ascii_lower, hex_digest, row_of, split_words, whole
from searchloom.sinks.tables import staged

WINDOW_WORDS = 10
#: the table of windows is broadcast up to this size; beyond it keys are shuffled
MAX_BROADCAST_BYTES = 64 << 20


def words_of(text: str | Column) -> Column:
    return split_words(ascii_lower(whole(text)), ASCII_GAPS)


def _key(words: Column, at: Column | int, n: int) -> Column:
    """64 bits of four words spread over the window, and its length."""
    offsets = sorted({0, n // 3, 2 * n // 3, n - 1})
    return F.xxhash64(F.lit(n), *[F.get(words, at + F.lit(k)) for k in offsets])


def _keys(words: Column, n: int) -> Column:
    """The key of each window start; no key if the words are fewer."""
    starts = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(starts, lambda i: _key(words, i, n))).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = WINDOW_WORDS) -> DataFrame:
    """(key, n, gram, item): the distinct windows of each item."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(text_col).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("n", F.least(F.size("words"), F.lit(n)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)
    grams = items.select("item", "n", F.explode(F.transform(starts, lambda i: F.slice(F.col("words"), i, F.col("n")))).alias("gram"))
    keys = F.lit(None).cast("bigint")
    for length in range(1, n + 1):
        keys = F.when(F.col("n") == length, _key(F.col("gram"), 0, length)).otherwise(keys)
    return grams.distinct().select(keys.alias("key"), "n", "gram", "item")


def hits(documents: DataFrame, benchmark: DataFrame, keep: list[str], *, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", n: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: ``keep`` as struct ``kept``, ``n_words``, ``spans`` (start, length in words; sorted) and ``items`` (sorted).

    Words count from 0. Equal spans of several items appear once.
    """
    windows = staged(benchmark_windows(benchmark, item_col, item_text_col, n), "benchmark-windows")
    facts = windows.agg(F.collect_set("n").alias("lengths"), F.sum(F.size("gram") * 24 + 64).alias("bytes")).first()
    lengths = sorted(facts["lengths"])
    if (facts["bytes"] or 0) > MAX_BROADCAST_BYTES:
        docs = documents.select(row_of(keep).alias("kept"), words_of(text_col).alias("words"))
        return _hits_by_keys(staged(docs.withColumn("row", F.monotonically_increasing_id()), "benchmark-words"), windows, lengths)
    table = F.broadcast(windows)

    words = F.col("words")
    docs = documents.select(row_of(keep).alias("kept"), words_of(text_col).alias("words"))
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    # the last, null key keeps a row for every document
    keys = F.concat(*[_keys(words, k) for k in lengths], F.array(F.lit(None).cast("bigint")))
    starts = docs.select("row", "kept", "words", F.posexplode(keys).alias("at", "key"))
    found = starts.join(table, "key", "left")
    begin = F.col("at")
    for k in lengths:  # windows of shorter lengths come first among the keys
        begin = begin - F.when(F.col("n") > k, F.greatest(F.size(words) - (k - 1), F.lit(0))).otherwise(0)
    found = found.where(F.col("key").isNull() | F.col("gram").isNotNull())
    hit = (F.slice(words, begin + 1, F.coalesce("n", F.lit(1))) == F.col("gram")) & F.col("gram").isNotNull()
    found = found.select(
        "row", F.when(F.col("key").isNull(), F.col("kept")).alias("kept"), F.size(words).cast("long").alias("n_words"),
        F.when(hit, F.struct(begin.cast("long").alias("start"), F.col("n").cast("long").alias("length"))).alias("span"),
        F.when(hit, F.col("item")).alias("item"),
    )
    # a span or an item is collected once per document, so what a document gathers is bounded by its own words and by the benchmark
    return found.groupBy("row").agg(
        F.first("kept", ignorenulls=True).alias("kept"), F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"),
    ).drop("row")


def key_places(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(row, start, n, key) of the document windows whose key occurs in the benchmark."""
    words = F.col("words")
    places = F.concat(*[F.transform(_keys(words, k), lambda key, at: F.struct(at.alias("start"), F.lit(k).alias("n"), key.alias("key"))) for k in lengths])
    return docs.select("row", F.inline(places)).join(windows.select("key").distinct(), "key", "left_semi")


def _hits_by_keys(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """``hits`` of written documents (row, kept, words), by shuffles of keys and of the windows that have one."""
    # a document's places are no more than its words, for each length
    places = key_places(docs, windows, lengths).groupBy("row").agg(F.collect_list(F.struct("start", "n", "key")).alias("places"))
    grams = F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["key"].alias("key"), F.slice("words", p["start"] + 1, p["n"]).alias("gram")))
    found = docs.select("row", "words").join(places, "row").select("row", F.inline(grams)).join(windows, ["key", "gram"])
    spans = found.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct(F.col("start").cast("long").alias("start"), F.col("n").cast("long").alias("length")))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    return docs.select("row", "kept", F.size("words").cast("long").alias("n_words")).join(spans, "row", "left").select(
        "kept", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))

    def add(state, span):
        end = F.greatest(state["end"], span["start"] + span["length"])
        return F.struct(end.alias("end"), (state["sum"] + end - F.greatest(state["end"], span["start"])).alias("sum"))

    return F.aggregate(spans, zero, add, lambda s: s["sum"])


def report(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **columns) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``."""
    found = hits(documents, benchmark, [id_col], **columns)
    return found.select(
        F.col("kept")[id_col].alias(id_col), "n_words", _covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        hex_digest(F.array_join("items", ",")).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "spans",
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The documents without any hit, all columns kept."""
    names = documents.columns
    found = hits(documents, benchmark, names, **columns)
    return found.where(F.size("spans") == 0).select(*[F.col("kept")[c].alias(c) for c in names])


def without_spans(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **columns) -> DataFrame:
    """All documents, with the hit words cut out of their texts; what stands between words stays."""
    names = documents.columns
    found = hits(documents, benchmark, names, text_col=text_col, **columns)
    text = F.coalesce(F.col("kept")[text_col], F.lit(""))
    words, gaps = split_words(text, CASED_GAPS), F.split(text, CASED_GAPS.replace("[", "[^", 1), -1)
    hit = lambda i: F.exists("spans", lambda s: (s["start"] <= i) & (i < s["start"] + s["length"]))
    parts = F.transform(gaps, lambda gap, i: F.concat(gap, F.when(hit(i), "").otherwise(F.coalesce(F.get(words, i), F.lit("")))))
    text = F.when(F.size("spans") == 0, F.col("kept")[text_col]).otherwise(F.array_join(parts, ""))
    return found.select(*[(text if c == text_col else F.col("kept")[c]).alias(c) for c in names])
