"""Byte limits of stream messages and documents."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C

ENVELOPE_FIELDS = [name for name, _ in C.CONTRACT_FIELDS if name != "raw_payload"]


def _escape_growth(text: Column) -> Column:
    """Bytes added when < > & are written as six-byte escapes."""
    return 5 * (F.length(text) - F.length(F.translate(text, "<>&", "")))


def envelope_bytes() -> Column:
    """Encoded size of a contract message without its raw payload."""
    text = F.to_json(F.struct(*[F.col(n) for n in ENVELOPE_FIELDS]))
    return F.octet_length(text) + _escape_growth(text)


def payload_bytes() -> Column:
    """Encoded size of the inlined raw payload with its key and comma."""
    raw = F.col("raw_payload")
    return F.coalesce(F.octet_length(raw) + _escape_growth(raw) + len(',"raw_payload":'), F.lit(0))


def degrade_oversize(messages: DataFrame, limit: int = C.MAX_MESSAGE_BYTES) -> DataFrame:
    """Drop the raw payload of messages over the limit; flag those still too large.

    Adds ``fit``: ``whole``, ``degraded`` (payload dropped) or ``oversize`` (dead letter).
    """
    sized = messages.withColumn("_envelope", envelope_bytes()).withColumn("_payload", payload_bytes())
    return (
        sized.withColumn(
            "fit",
            F.when(F.col("_envelope") + F.col("_payload") <= limit, F.lit("whole"))
            .when(F.col("_envelope") <= limit, F.lit("degraded"))
            .otherwise(F.lit("oversize")),
        )
        .withColumn("raw_payload", F.when(F.col("fit") == "whole", F.col("raw_payload")))
        .drop("_envelope", "_payload")
    )


def document_bytes() -> Column:
    """Encoded size of a document, its stored payload text counted inline."""
    rest = F.to_json(F.struct(*[F.col(f"`{n}`") for n in C.DOC_COLUMNS if n not in ("_id", "payloadRaw")]))
    return F.octet_length(rest) + F.coalesce(F.octet_length("payloadRaw"), F.lit(0))


def request_bytes(docs: str) -> Column:
    """Encoded size of a message's documents together: the parent and all derived ones go in one request."""
    def one(d: Column) -> Column:
        rest = F.to_json(F.struct(*[d[n].alias(n) for n in C.DOC_COLUMNS if n not in ("_id", "payloadRaw")]))
        return F.octet_length(rest) + F.coalesce(F.octet_length(d["payloadRaw"]), F.lit(0))

    return F.aggregate(docs, F.lit(0).cast("bigint"), lambda acc, d: acc + one(d))


def oversize_request(docs: str, limit: int = C.MAX_DOC_BYTES) -> Column:
    """Whether no request can carry the documents. Encoding them is left out where all their texts are far below the limit.

    What a parent projects out of its payload repeats the payload's text, twice at most, in
    escapes of up to six bytes; what it takes from the envelope is counted for each document.
    A parent without its payload is always encoded.
    """
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")

    def texts(d: Column) -> Column:
        viewers = F.aggregate(F.coalesce(d["visibles"], F.array().cast("array<string>")), F.lit(0).cast("bigint"), lambda n, v: n + size(v) + 3)
        return functools.reduce(lambda a, n: a + size(d[n]), ("payloadRaw", "from", "to", "channelId", "spaceId", "source"), viewers)

    total = F.aggregate(docs, F.lit(0).cast("bigint"), lambda acc, d: acc + texts(d))
    bare = F.exists(docs, lambda d: d["payloadRaw"].isNull() & d["parentMessageId"].isNull())
    may = bare | (total * 13 + F.size(docs) * 100_000 > limit)
    return F.when(may, request_bytes(docs) > limit).otherwise(F.lit(False))


def oversize_documents(docs: DataFrame, limit: int = C.MAX_DOC_BYTES) -> DataFrame:
    """Documents that no request can carry: permanent status 413."""
    return docs.withColumn("doc_bytes", document_bytes()).where(F.col("doc_bytes") > limit).withColumn(
        "status", F.lit(413)
    )
