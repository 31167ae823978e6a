"""Document fingerprints by one-permutation MinHash: every shingle is hashed once.

1. A text's words (cut at ASCII white space, A-Z lower-cased) give shingles of five words, each
   hashed to 64 bits. The top bits choose one of ``BINS`` bins; the least hash of each bin is kept.
2. Empty bins are filled by optimal densification: an empty bin walks a pseudo-random sequence of
   bins of its own up to the first that holds a hash, and takes that. The sequence does not depend
   on the text, so two texts that fill the same bins alike also borrow alike. After ``STEPS`` misses
   the walk goes on over the filled bins alone, in an order that again depends on the bin only.
3. Of each bin the lowest ``BITS`` bits are packed: ``BINS * BITS / 8`` bytes for a text of any length.
4. Bins of unlike content agree by chance once in ``2 ** BITS``; ``likeness`` takes that out of the
   share of agreeing bins, so it estimates the Jaccard similarity of the shingle sets without bias
   but for the cut at 0 and 1. Its standard error is about ``sqrt(s * (1 - s) / BINS)``, below 0.04.

Fingerprints are made where a text is read, within one row. The report moves texts only to edit
them: documents are ordered by narrow keys, in ranges, and each receives the head of the next one.

Only DataFrame functions are used.

Defined cases: a null text is an empty one. A text without words has an empty fingerprint, like
other such texts (1) and unlike all else (0); one of fewer than five words is one shingle. Rows of
one id and equal texts are one document that is there several times, with equal results in each
row. Other rows that share an id, or have none, are separate documents, those without id come
first; they follow each other by 128 bits of their texts. A document that is the only one is its
own next. Very long texts are taken whole. Empty tables give no rows. Other columns are not read,
or are carried along, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from searchloom.llm.texts import SPACES, ascii_lower, hex_digest, named, row_of, split_words, whole
from searchloom.sinks.tables import staged

WORDS = 5
BINS, BITS = 256, 4
#: a hash without its lowest bit is a natural number of 63 bits; what lies above these is its bin
BIN_SHIFT = 63 - (BINS.bit_length() - 1)
#: steps of a walk before it goes over the filled bins alone; with half of the bins filled it never comes to that
STEPS = 24
KEY = ["id", "h1", "h2"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(words: Column) -> Column:
    """Hashes of 63 bits of all shingles; of fewer words the one of all of them."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        each = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WORDS)]))
        return F.when(n >= WORDS, each).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))

    return F.transform(_let(F.transform(words, lambda w: F.xxhash64(w)), of), lambda h: F.shiftrightunsigned(h, 1))


def _bin(value: Column) -> Column:
    return F.shiftright(value, BIN_SHIFT).cast("int")


def _least_of_bins(values: Column) -> Column:
    """The least hash of each filled bin, by bin."""
    first = lambda ordered: F.filter(ordered, lambda v, i: (i == 0) | (_bin(v) > _bin(F.get(ordered, i - 1))))
    return _let(F.sort_array(values), first)


def _densified(least: Column) -> Column:
    """One hash for each bin: its own, or that of the filled bin its walk comes to first."""
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))

    def fill(own: Column) -> Column:
        step = lambda k, t: F.get(own, F.xxhash64(k, F.lit(t)).bitwiseAND(F.lit(BINS - 1)).cast("int"))
        rank = lambda k: lambda v: F.struct(F.xxhash64(k, F.lit(STEPS), _bin(v)).alias("rank"), v.alias("v"))
        last = lambda k: F.array_min(F.transform(least, rank(k)))["v"]
        return F.transform(own, lambda v, k: F.coalesce(v, *[step(k, t) for t in range(STEPS)], last(k)))

    by_bin = lambda known: F.transform(bins, lambda k: F.try_element_at(known, k))
    return _let(_let(F.map_from_arrays(F.transform(least, _bin), least), by_bin), fill)


def fingerprint(text: Column, words: Callable[[Column], Column] | None = None) -> Column:
    """The packed low bits of all bins; empty for a text without words."""
    cut = words or (lambda t: split_words(ascii_lower(t), SPACES))

    def packed(least: Column) -> Column:
        # BITS are those of one hexadecimal digit
        digits = F.transform(_densified(least), lambda v: F.hex(v.bitwiseAND(F.lit(2**BITS - 1))))
        return F.when(F.size(least) > 0, F.unhex(F.array_join(digits, ""))).otherwise(F.lit(b""))

    return _let(_least_of_bins(_shingles(cut(whole(text)))), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts behind two fingerprints, 0 to 1."""
    digits = lambda x: F.split(F.hex(x), "")
    agreeing = F.size(F.filter(F.zip_with(digits(a), digits(b), lambda x, y: x == y), lambda same: same))
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (agreeing / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when(a == b, F.lit(1.0)).when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(corrected)


def fingerprints(documents: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """The documents with a column of packed fingerprints beside all others; a column of that name is replaced."""
    names = [c for c in documents.columns if c != name]
    rows = documents.select(row_of(names).alias("doc"), fingerprint(named(text_col)).alias("mark"))
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in names], F.col("mark").alias(name))


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = documents.select(named(id_col).alias("id"), whole(named(text_col)).alias("text"))
    return rows.select("id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")


def _followers(marks: DataFrame) -> DataFrame:
    """Each distinct document beside the one before it (``p…``), the first beside the last, and how like they are.

    Documents are dealt out in ranges of their keys. Within a range a window looks one row back;
    over its border looks a table of one row for each range.
    """
    classes = marks.groupBy(*KEY, "n", "mark").count().repartitionByRange(*KEY)
    ordered = staged(classes.select(*KEY, "n", "mark", F.spark_partition_id().alias("part")), "print-order")
    before = lambda c: F.lag(c).over(Window.partitionBy("part").orderBy(*KEY))
    row = F.struct(*KEY, "n", "mark")
    ends = ordered.groupBy("part").agg(F.max(row).alias("last")).orderBy("part").collect()
    parts = [r.part for r in ends]
    kind = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("border", ordered.select(row.alias("r")).schema["r"].dataType)])
    borders = ordered.sparkSession.createDataFrame([(p, ends[i - 1].last) for i, p in enumerate(parts)], kind)
    rows = ordered.select(*KEY, "mark", "part", before(row).alias("previous"))
    # one row for each range of a shuffle
    rows = rows.join(F.broadcast(borders), "part").withColumn("previous", F.coalesce("previous", "border"))
    return rows.select(*KEY, *[F.col(f"previous.{c}").alias(f"p{c}") for c in [*KEY, "n", "mark"]], likeness(F.col("previous.mark"), F.col("mark")).alias("near_next"))


def _same(left: DataFrame, right: DataFrame, prefix: str = "") -> Column:
    return left["id"].eqNullSafe(right[f"{prefix}id"]) & (left["h1"] == right[f"{prefix}h1"]) & (left["h2"] == right[f"{prefix}h2"])


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, and fingerprints and likeness of the text, of the text edited, and of the next document.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many
    (or all) of the next document by id; the document after the last one is the first.
    """
    keyed = _keyed(documents, id_col, text_col)
    marks = staged(keyed.select(*KEY, F.length("text").alias("n"), fingerprint(F.col("text")).alias("mark")), "print-marks")
    columns = [F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars")]
    if marks.isEmpty():
        none = {"edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}
        return marks.select(*columns, *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()])
    links = staged(_followers(marks), "print-links")

    half = F.floor(F.col("pn") / 2).cast("int")
    sent = keyed.join(links, _same(keyed, links)).select("pid", "ph1", "ph2", "pn", "pmark", "near_next", F.substring("text", F.lit(1), half).alias("head"))
    # equal rows send equal heads
    heads = sent.groupBy("pid", "ph1", "ph2").agg(*[F.max(c).alias(c) for c in ("pn", "pmark", "near_next", "head")])
    rows = keyed.join(heads, _same(keyed, heads, "p"))
    rows = rows.select("id", F.col("pn").alias("n"), F.col("pmark").alias("mark"), "near_next", F.concat(F.substring("text", F.lit(1), F.col("pn") - half), "head").alias("edited"))
    rows = rows.select("id", "n", "mark", "near_next", hex_digest(F.col("edited")).alias("edited_sha256"), fingerprint(F.col("edited")).alias("emark"))
    return rows.select(
        *columns, "edited_sha256", F.lower(F.hex("mark")).alias("fingerprint"), F.lower(F.hex("emark")).alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("emark")).alias("near_edited"), "near_next",
    )
