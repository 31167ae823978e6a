"""Small frames for tests."""

from __future__ import annotations

from searchloom import contract as C
from searchloom.operators import documents, enrich


def row(message_id="1", payload='{"type":1,"content":"x"}', **over):
    base = dict(
        shard_table="message", id=1, message_id=message_id, message_seq=7, from_uid="u1", channel_id="g1", channel_type=2,
        setting=0, signal=0, timestamp=1700000000, created_unix=1700000001,
        payload=payload.encode() if isinstance(payload, str) else payload,
    )
    return {**base, **over}


def rows(spark, *items):
    names = [n for n, _ in C.ROW_FIELDS]
    return spark.createDataFrame([tuple(i[n] for n in names) for i in items], C.ddl(C.ROW_FIELDS))


def payload_rows(spark, payloads):
    return rows(spark, *[row(str(i + 1), p, id=i + 1) for i, p in enumerate(payloads)])


def docs(spark, payloads):
    """Documents by _id of payloads numbered from 1."""
    routed = enrich.with_route(payload_rows(spark, payloads))
    out = documents.documents(enrich.contract_rows(routed, ["body"]))
    return {r["_id"]: r for r in out.collect()}


def message(**over):
    base = dict(
        schema_version=2, message_id="5", message_seq=1, channel_id="g", channel_type=2, from_uid="u", content=None, content_type=0,
        raw_payload=None, raw_excluded=False, space_id=None, visibles=None, msg_timestamp=10, created_at=11, source="s",
    )
    return {**base, **over}


def messages(spark, *items):
    names = [n for n, _ in C.CONTRACT_FIELDS]
    return spark.createDataFrame([tuple(i[n] for n in names) for i in items], C.ddl(C.CONTRACT_FIELDS))
