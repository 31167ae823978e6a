"""Search predicates over documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import textx
from searchloom.operators.enrich import unpacked


def term(path: str, value) -> Column:
    """Exact value; a keyword longer than its limit is stored but never found."""
    col = F.col(path)
    limit = C.KEYWORD_LIMITS.get(path)
    if path == "visibles":
        return F.coalesce(F.exists(col, lambda x: (x == value) & (F.length(x) <= limit)), F.lit(False))
    if ".msgs." in path:
        # a field of array elements reads as an array
        return F.coalesce(F.array_contains(col, value), F.lit(False))
    hit = col == F.lit(value)
    if limit is not None:
        hit = hit & (F.length(col) <= limit)
    return F.coalesce(hit, F.lit(False))


def exists(path: str) -> Column:
    """Some value is there; the empty string counts."""
    return F.col(path).isNotNull()


def between(path: str, low: int, high: int) -> Column:
    return F.coalesce(F.col(path).between(low, high), F.lit(False))


def match(path: str, query: str) -> Column:
    """Any word of the query is among the words of the text."""
    col = F.concat_ws(" ", F.col(path))
    return F.coalesce(F.arrays_overlap(textx.tokens(col), textx.tokens(F.lit(query))), F.lit(False))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def none_of(*conditions: Column) -> Column:
    """True unless a condition holds; a missing field never holds."""
    return all_of(*[~F.coalesce(c, F.lit(False)) for c in conditions])


def by_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose _id is listed."""
    return docs.join(ids.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_semi")


def inverted_index(docs: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Postings (token, doc_id, field, tf) of the analysed fields.

    The tokens of one text are counted inside its row, so the exploded postings need no
    shuffle; a common word never gathers in one task.
    """
    fields = F.array(
        *[
            F.struct(F.lit(p).alias("field"), F.concat_ws(" ", F.col(p)).alias("text"))
            for p in paths or C.TEXT_PATHS
        ]
    )
    texts = docs.select(F.col("_id").alias("doc_id"), F.explode(fields).alias("f")).select(
        "doc_id", "f.field", F.array_sort(textx.tokens(F.col("f.text"))).alias("words")
    )
    # in sorted words a run ends where the next word differs; run ends give the counts
    ends = F.filter(
        F.transform("words", lambda w, i: F.when(F.coalesce(F.get("words", i + 1) != w, F.lit(True)), i + 1)),
        lambda e: e.isNotNull(),
    )
    counted = texts.withColumn("ends", ends).select(
        "doc_id",
        "field",
        F.transform(
            "ends",
            lambda e, i: F.struct(
                F.get("words", e - 1).alias("token"), (e - F.coalesce(F.get("ends", i - 1), F.lit(0))).alias("tf")
            ),
        ).alias("postings"),
    )
    return unpacked(counted, "postings", "doc_id", "field")
