"""Dead-letter records of the four legs, their store and its window reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C


def producer_letters(rows: DataFrame, reason: str = "reason", limit: int = C.MAX_DLQ_PAYLOAD_BYTES) -> DataFrame:
    """Envelopes of dead-lettered shard rows; ``produced_at`` is stamped when written.

    The payload is dropped, and the detail says so, when it is larger than ``limit`` or
    when the message itself was oversize.
    """
    drop = (F.octet_length("payload") > limit) | (F.col(reason) == C.PRODUCER_OVERSIZE)
    return rows.select(
        F.lit(C.DLQ_VERSION).alias("schema_version"),
        F.col(reason).alias("reason"),
        "shard_table",
        F.col("id").alias("source_id"),
        "message_id",
        "channel_id",
        "channel_type",
        F.when(~drop, F.col("payload")).alias("raw_payload"),
        F.when(drop, F.lit(C.PAYLOAD_DROPPED_NOTE)).alias("detail"),
        F.col("created_unix").alias("created_at"),
        F.col("timestamp").alias("msg_timestamp"),
    )


def indexer_letters(items: DataFrame, limit: int = C.MAX_DLQ_PAYLOAD_BYTES) -> DataFrame:
    """Records of the index leg from (topic, partition, offset, key, value, reason, status, error).

    Schema and access-list failures have status 0 and no error text. A value over
    ``limit`` is dropped whole and a note is appended to the detail.
    """
    size = F.octet_length("value")
    cut = size > limit
    checked = F.col("reason").isin(C.INDEXER_SCHEMA, C.INDEXER_UNTRUSTED)
    error = F.when(~checked & (F.col("error") != ""), F.col("error"))
    note = F.when(
        cut,
        F.concat(
            F.lit("value left out: "), size.cast("string"), F.lit(f" bytes are over {limit}; "),
            F.lit("for a replay fetch the message of this key from its source"),
        ),
    )
    return items.select(
        "reason", "topic", "partition", "offset", "key",
        F.when(~cut, F.col("value")).alias("value"),
        F.when(checked, F.lit(0)).otherwise(F.col("status")).alias("status"),
        F.concat_ws("; ", error, note).alias("detail"),
        cut.alias("payload_truncated"),
    )


def spilled(letters: DataFrame, now_unix: int, column: str = "spilled_at") -> DataFrame:
    """The letters with the time at which they are written."""
    return letters.withColumn(column, F.lit(now_unix).cast("bigint"))


def file_letters(items: DataFrame, limit: int = C.MAX_DLQ_PAYLOAD_BYTES) -> DataFrame:
    """Records of the file leg; a long value keeps its first ``limit`` bytes."""
    return items.select(
        "reason", "topic", "partition", "offset", "key",
        F.substring("value", 1, limit).alias("value"),
        F.col("message_id").alias("messageId"),
        F.col("url").alias("fileURL"),
        F.col("extension").alias("fileExt"),
        F.col("size").alias("fileSize"),
        F.col("error").alias("detail"),
        (F.octet_length("value") > limit).alias("payloadTruncated"),
    )


def load_letters(rows: DataFrame) -> DataFrame:
    """Records of the historical load from shard rows with a ``reason``."""
    return rows.select(
        F.coalesce(F.nullif("reason", F.lit("")), F.lit(C.LOAD_DEFAULT)).alias("reason"),
        F.col("shard_table").alias("table"),
        "id", "message_id", "payload",
        F.col("created_unix").alias("created_at"),
    )


def dedup_key() -> Column:
    """message_id, or table:id when that is empty."""
    return F.when(F.coalesce(F.col("message_id"), F.lit("")) != "", F.col("message_id")).otherwise(
        F.concat_ws(":", "table", F.col("id").cast("string"))
    )


def first_per_key(letters: DataFrame) -> DataFrame:
    """The first record of each key in table and id order.

    ``min_by`` combines before the shuffle, so a key that holds a large share of the
    records still sends one row per task.
    """
    record = F.struct(*letters.columns)
    return (
        letters.groupBy(dedup_key().alias("dedup_key"))
        .agg(F.min_by(record, F.struct("table", "id", "created_at", "reason")).alias("r"))
        .select("dedup_key", "r.*")
    )


def new_letters(letters: DataFrame, stored: DataFrame) -> DataFrame:
    """First records whose key is not stored yet."""
    seen = stored.select(dedup_key().alias("dedup_key")).distinct()
    return first_per_key(letters).join(seen, "dedup_key", "left_anti")


def window_ids(letters: DataFrame, from_unix: int, to_unix: int) -> DataFrame:
    """Distinct non-empty message ids with created_at inside the window."""
    return (
        letters.where(F.col("created_at").between(from_unix, to_unix) & (F.col("message_id") != ""))
        .select("message_id")
        .distinct()
    )


def window_count(letters: DataFrame, from_unix: int, to_unix: int) -> DataFrame:
    """Distinct keys with created_at inside the window."""
    return letters.where(F.col("created_at").between(from_unix, to_unix)).agg(
        F.count_distinct(dedup_key()).alias("dlq_keys")
    )


def count_by_reason(legs: dict[str, DataFrame]) -> DataFrame:
    """Records per leg and reason."""
    frames = [df.select(F.lit(leg).alias("leg"), "reason") for leg, df in legs.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.groupBy("leg", "reason").agg(F.count(F.lit(1)).alias("records"))
