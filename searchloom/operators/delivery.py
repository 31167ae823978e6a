"""Outcome of writes: status classes, dispositions, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import jsonx

OK = "ok"
DLQ = "dlq_resolved"
TRANSIENT = "transient"


def status_class(status: Column) -> Column:
    """HTTP status of a document write: ok, permanent or transient (0 means no answer)."""
    return (
        F.when(status.between(200, 299), F.lit("ok"))
        .when(status.between(400, 499) & ~status.isin(409, 429), F.lit("permanent"))
        .otherwise(F.lit("transient"))
    )


def update_status_class(status: Column) -> Column:
    """HTTP status of a partial update: a missing document is waited for."""
    return (
        F.when(status.between(200, 299), F.lit("ok"))
        .when(status == 404, F.lit("doc_not_yet"))
        .when(status.isin(409, 429) | (status >= 500), F.lit("transient"))
        .when(status >= 400, F.lit(C.FILE_OS))
        .otherwise(F.lit("transient"))
    )


def disposition(status: Column) -> Column:
    """What a write outcome means for stream progress."""
    kind = status_class(status)
    return F.when(kind == "ok", F.lit(OK)).when(kind == "permanent", F.lit(DLQ)).otherwise(F.lit(TRANSIENT))


def numeric_id(messages: DataFrame) -> DataFrame:
    """Index id of each message; ids that are no number get permanent status 400."""
    number = jsonx.integer_text(F.col("message_id"))
    return messages.withColumn("doc_id", number.cast("string")).withColumn(
        "status", F.when(number.isNull(), F.lit(400))
    )


def parent_results(results: DataFrame) -> DataFrame:
    """One result per parent from (parent_id, sub_seq, status).

    A parent is ok only if it and all derived documents are; its own failure wins over
    theirs, then the failing one with the lowest sub_seq.
    """
    failed = status_class(F.col("status")) != "ok"
    first = F.min(F.when(failed, F.struct("sub_seq", "status")))
    return (
        results.groupBy("parent_id")
        .agg(
            first.alias("f"),
            F.max(F.when(F.col("sub_seq") == 0, F.col("status"))).alias("own"),
            F.count(F.lit(1)).alias("documents"),
        )
        .select(
            "parent_id",
            "documents",
            F.col("f").isNull().alias("ok"),
            F.coalesce("f.status", "own").alias("status"),
        )
    )


def latest_delivery(deliveries: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last delivery per key by ``order``; copies combine before the shuffle."""
    rest = [c for c in deliveries.columns if c != key]
    return (
        deliveries.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(key, "r.*")
    )


def backoff_seconds(attempt: Column, base: float, cap: float) -> Column:
    """Exponential wait before attempt n (from 1), capped."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1), F.lit(float(cap)))


def retry_pass(
    pending: DataFrame, now_unix: int, max_attempts: int | None, base: float, cap: float
) -> DataFrame:
    """State of each item after one pass over (key, attempts, status).

    ``attempts`` counts passes already made. An item is resolved by its status; a
    transient one waits for its next attempt, or ends as retry_exhausted once it has had
    ``max_attempts``; None never gives up. Waiting is a time in a column, not a sleep.
    """
    kind = update_status_class(F.col("status"))
    done = F.col("attempts") + 1
    give_up = F.lit(False) if max_attempts is None else F.col("attempts") >= max_attempts
    state = (
        F.when(give_up, F.lit(C.FILE_RETRY))
        .when(kind == "ok", F.lit("ok"))
        .when(kind == C.FILE_OS, F.lit(C.FILE_OS))
        .otherwise(F.lit("waiting"))
    )
    return pending.withColumn("state", state).select(
        "key",
        F.when(F.col("state") == C.FILE_RETRY, F.col("attempts")).otherwise(done).alias("attempts"),
        "state",
        F.when(
            F.col("state") == "waiting",
            F.lit(now_unix) + F.ceil(backoff_seconds(done, base, cap)).cast("bigint"),
        ).alias("next_attempt_at"),
    )
