"""Load all history: rows to documents and dead letters, restartable."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.operators import deadletters, documents, enrich, limits, metrics, upsert
from searchloom.sinks import tables
from searchloom.sinks.docstore import ConcurrentWrite, DocumentStore
from searchloom.sinks.letters import LetterStore
from searchloom.sinks.pointer import VersionedPointer
from searchloom.sources import shards

LETTER_DDL = (
    "dedup_key string, reason string, `table` string, id bigint, message_id string, payload binary, created_at bigint"
)


@dataclass
class LoadTarget:
    """Where a load writes; the same target given again resumes it."""

    store: DocumentStore
    dlq_root: str
    cursors: VersionedPointer

    @classmethod
    def below(cls, spark: SparkSession, root: str, **store_options) -> LoadTarget:
        return cls(
            DocumentStore(spark, f"{root}/docs", **store_options),
            f"{root}/dlq",
            VersionedPointer(spark, f"{root}/cursors"),
        )


def judged_rows(rows: DataFrame, max_doc_bytes: int = C.MAX_DOC_BYTES) -> DataFrame:
    """Each row with its documents, or the reason it is dead-lettered. No shuffle."""
    routed = enrich.with_route(rows)
    keep = ["shard_table", "id", "message_id", "payload", "created_unix", "outcome", "reason"]
    messages = routed.select(*keep, "body", F.struct(*enrich.message_columns()).alias("m"))
    lifted = messages.select(
        *[F.col(k).alias(f"row_{k}") for k in keep], "body", "m.*"
    )
    projected = documents.with_projection(lifted)
    refused = (
        F.when(F.col("row_reason") == C.PRODUCER_UNPARSEABLE, F.lit(C.LOAD_PARSE))
        .when(F.col("row_reason").isNotNull(), F.lit(C.LOAD_CONVERT))
        .when(F.col("doc_number").isNull(), F.lit(C.LOAD_CONVERT))
    )
    projected = projected.withColumn("reason", refused).withColumn("docs", F.when(F.col("reason").isNull(), documents.doc_array()))
    large = F.col("docs").isNotNull() & limits.oversize_request("docs", max_doc_bytes)
    projected = projected.withColumn("reason", F.when(large, F.lit(C.LOAD_REJECT)).otherwise(F.col("reason")))
    return projected.select(
        *[F.col(f"row_{k}").alias(k) for k in keep if k != "reason"],
        "reason",
        F.when(F.col("reason").isNull(), F.col("docs")).alias("docs"),
    )


def run(rows: DataFrame, target: LoadTarget, counters: Observation | None = None) -> DataFrame:
    """Load the rows above the cursors; returns the judged rows of this run.

    ``counters`` is filled while the rows are written: ``items``, ``ok``, ``raw_excluded`` of
    these, and each reason of a dead letter.

    Order: dead letters, documents, cursors. A run that dies in between is repeated from
    the old cursors, finds its letters stored and writes the same documents again.
    """
    spark = rows.sparkSession
    version, cursors = target.cursors.read()
    dead = F.col("reason").isNotNull()
    judged = (
        judged_rows(tables.dealt(shards.scan(rows, cursors)))
        .withColumn("leg", F.when(dead, F.lit("dlq")).otherwise(F.lit("docs")))
        .withColumn("payload", F.when(dead, F.col("payload")))  # documents hold theirs
    )
    by = metrics.reasons("reason", [C.LOAD_PARSE, C.LOAD_CONVERT, C.LOAD_REJECT])
    by["raw_excluded"] = F.col("reason").isNull() & (F.col("outcome") == enrich.ROUTE_RAW)
    staged = tables.staged(metrics.observed(judged, counters, by), "load", partition_by="leg")
    letters = deadletters.load_letters(staged.where(F.col("leg") == "dlq"))
    LetterStore(spark, target.dlq_root, LETTER_DDL).append(letters, f"{version + 1:012d}")
    good = staged.where(F.col("leg") == "docs")
    docs = good.select("shard_table", "id", F.inline("docs"))
    target.store.upsert(upsert.newest_documents(docs, ["shard_table", "id"]))
    tops = staged.groupBy("shard_table").agg(F.max("id")).collect()  # one row per shard
    if not target.cursors.commit(version, {**cursors, **{s: top for s, top in tops}}):
        raise ConcurrentWrite("another load moved the cursors; what was written here is found again by key")
    return staged


def letters(spark: SparkSession, target: LoadTarget) -> DataFrame:
    return LetterStore(spark, target.dlq_root, LETTER_DDL).read()
