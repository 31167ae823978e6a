"""From shard row to contract message: encryption, parsing, access list, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import jsonx
from searchloom.session import built_once

ROUTE_OK = "ok"
ROUTE_RAW = "raw_excluded"
ROUTE_DLQ = "dlq"

# every payload field some operator reads
BODY_FIELDS = [
    "type", "content", "space_id", "visibles", "url", "name", "caption", "width", "height",
    "cover", "second", "size", "extension", "msgs", "plain",
]


def is_encrypted(signal: str = "signal", setting: str = "setting") -> Column:
    """The signal column, or bit 5 of the settings."""
    return (F.col(signal) != 0) | (F.col(setting).bitwiseAND(C.SIGNAL_BIT) != 0)


def with_payload(rows: DataFrame) -> DataFrame:
    """Decode the payload bytes once: ``payload_text`` and ``body`` (its fields, or null)."""
    rows = rows.withColumn("payload_text", F.make_valid_utf8(F.col("payload").cast("string")))
    return jsonx.with_json_object(rows, "payload_text", "body", BODY_FIELDS)


def visibility(body: Column) -> Column:
    """Access list of a payload, fail-closed: struct<trusted, space_id, visibles>.

    No ``visibles`` key means everyone. A key that is null, not an array, or without
    a single non-empty string cannot be trusted. A strange space_id harms nothing.
    """
    names = F.filter(
        F.transform(jsonx.array_of(body["visibles"]), jsonx.string_of),
        lambda s: s.isNotNull() & (s != ""),
    )
    absent = body["visibles"].isNull()
    return F.struct(
        (body.isNotNull() & (absent | (F.coalesce(F.size(names), F.lit(0)) > 0))).alias("trusted"),
        jsonx.string_of(body["space_id"]).alias("space_id"),
        F.when(~absent, names).alias("visibles"),
    )


def with_route(rows: DataFrame) -> DataFrame:
    """Three-way route of every row, with the reason where it is dead-lettered.

    Adds encrypted, payload_text, body, acl, content_type, content, outcome, reason.
    """
    rows = with_payload(rows)
    for name, column in _route_steps():
        rows = rows.withColumn(name, column)
    return rows


@built_once
def _route_steps() -> list[tuple[str, Column]]:
    open_ = ~F.col("encrypted")
    number = F.when(open_, jsonx.truncated_number_of(F.col("body.type")))
    reason = (
        F.when(F.col("encrypted"), F.lit(None))
        .when(F.col("body").isNull(), F.lit(C.PRODUCER_UNPARSEABLE))
        .when(~F.col("acl.trusted"), F.lit(C.PRODUCER_UNTRUSTED))
    )
    text = F.when(
        open_ & F.col("reason").isNull() & (F.col("content_type") == C.TYPE_TEXT),
        jsonx.string_of(F.col("body.content")),
    )
    outcome = (
        F.when(F.col("reason").isNotNull(), F.lit(ROUTE_DLQ))
        .when(F.col("content").isNull(), F.lit(ROUTE_RAW))
        .otherwise(F.lit(ROUTE_OK))
    )
    return [
        ("encrypted", is_encrypted()),
        ("acl", F.when(open_, visibility(F.col("body")))),
        ("content_type", F.coalesce(number, F.lit(0).cast("bigint"))),
        ("reason", reason.cast("string")),
        ("content", text),
        ("outcome", outcome),
    ]


def message_columns() -> list[Column]:
    """Contract fields of a routed row; an encrypted row never carries its payload."""
    open_ = ~F.col("encrypted")
    return [
        F.lit(C.CONTRACT_VERSION).alias("schema_version"),
        F.col("message_id"),
        F.greatest(F.col("message_seq"), F.lit(0)).alias("message_seq"),
        F.col("channel_id"),
        F.col("channel_type"),
        F.col("from_uid"),
        F.col("content"),
        F.col("content_type"),
        F.when(open_, F.col("payload_text")).alias("raw_payload"),
        (F.col("outcome") == ROUTE_RAW).alias("raw_excluded"),
        jsonx.empty_as_null(F.when(open_, F.col("acl.space_id"))).alias("space_id"),
        F.when(open_, F.col("acl.visibles")).alias("visibles"),
        F.col("timestamp").alias("msg_timestamp"),
        F.col("created_unix").alias("created_at"),
        F.lit(C.SOURCE_TAG).alias("source"),
    ]


def only(df: DataFrame, condition: Column, *columns) -> DataFrame:
    """``df.where(condition).select(*columns)`` that computes the condition's inputs once.

    The optimizer pushes a filter below the projections it reads, so a filter on a parsed
    value parses every payload twice, and nested ones multiply. An ``inline`` of a
    conditional one-row array keeps its place.
    """
    fields = F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns])
    return df.select(F.inline(F.when(condition, F.array(fields))))


def contract_rows(routed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Messages of all rows that are not dead-lettered, plus the ``keep`` columns."""
    return only(routed, F.col("outcome") != ROUTE_DLQ, *message_columns(), *(keep or []))


def unpacked(df: DataFrame, array: str, *columns: str) -> DataFrame:
    """One row per element of an array of structs, beside the named columns.

    The outer form keeps the optimizer from adding a filter on the array, which would
    compute the array twice; empty rows are dropped after.
    """
    out = df.select(*columns, F.explode_outer(array).alias("_e")).where(F.col("_e").isNotNull())
    return out.select(*columns, "_e.*")
