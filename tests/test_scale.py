"""What keeps the work of jobs in proportion to their input."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from helpers import message, messages, payload_rows, row, rows
from pyspark.sql import functions as F

from checks import queries
from searchloom import contract as C
from searchloom.operators import documents, wire
from searchloom.plans import historical
from searchloom.sinks import tables
from searchloom.sinks.docstore import DocumentStore
from searchloom.sinks.searchindex import SearchIndex
from searchloom.streaming import extraction, indexing

PAYLOADS = ['{"type":14,"content":[{"type":"text","text":"a \\" }"},[1,{"k":[2]}]]}', '{ "type" : 1.0 , "n":9007199254740993 }', "[ 1, [2] ]"]


def stream(spark, values):
    return spark.createDataFrame([("t", 0, i, bytearray(b"1"), bytearray(v.encode())) for i, v in enumerate(values)], C.ddl(C.STREAM_FIELDS))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def nested(depth):
    return '{"d":' * depth + "1.0" + "}" * depth


@pytest.mark.parametrize(
    "form",
    [
        '{"schema_version":2,"raw_payload":%s}', ' { "raw_payload" :\t%s\n, "x":{"raw_payload":{"type":9}}, "schema_version":2 } ',
        '{"content":"\\"raw_payload\\":{","raw_payload":%s ,"schema_version" : 2}',
    ],
)
def test_payload_is_found_by_one_pattern(spark, form):
    payloads = [*PAYLOADS, nested(wire.PATTERN_DEPTH)]
    text = stream(spark, [form % p for p in payloads]).withColumn("_text", F.col("value").cast("string"))
    assert [r[0] for r in text.select(wire._written_once()).collect()] == payloads


def test_payloads_beyond_the_pattern_are_walked(spark):
    deep, long_ = nested(30), json.dumps({"t": 'x"\\' * 200_000, "l": [[i] for i in range(50_000)]})
    values = [f'{{"raw_payload":{p},"schema_version":2}}' for p in (deep, long_)]
    values.append('{"raw_payload":{"a":1},"schema_version":2,"raw_payload":{"b":2.0}}')
    got = [r["raw_payload"] for r in wire.decode(stream(spark, values)).orderBy("offset").collect()]
    assert got == [deep, long_, '{"b":2.0}']


def test_a_batch_of_one_file_is_parsed_by_all_cores(spark, tmp_path):
    records = wire.encode(messages(spark, *[message(message_id=str(i), raw_payload='{"type":4}') for i in range(200)]), "t")
    records = records.select("topic", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), "key", "value")
    records.coalesce(1).write.parquet(str(tmp_path / "s"))
    batch = spark.read.schema(C.ddl(C.STREAM_FIELDS)).parquet(str(tmp_path / "s"))
    busy = tables.spread(batch).select(F.spark_partition_id()).distinct().count()
    assert busy >= spark.sparkContext.defaultParallelism
    store = DocumentStore(spark, str(tmp_path / "docs"), slot_width=10**16)
    indexing.index_batch(batch, "1", store, str(tmp_path / "dlq"))
    assert store.read().count() == 200


def test_file_messages_are_decoded_without_a_filter_below(spark):
    good = '{"schema_version":1,"message_id":"5","raw_payload":{"type":8,"url":"u","size":3}}'
    found, bad = extraction.decoded_files(stream(spark, [good, "junk", '{"message_id":"6","raw_payload":{"type":1,"n":8}}']))
    assert "Filter" not in plan(bad)
    assert [(r["message_id"], r["url"], r["size"], r["offset"]) for r in found.collect()] == [("5", "u", 3, 0)]
    assert [(r["message_id"], r["reason"], r["offset"]) for r in bad.collect()] == [("1", C.FILE_PARSE, 1)]


FILE = '{"type":8,"url":"https://files.example.com/docs/%d","name":"a.txt"}'


@pytest.mark.parametrize("name", ["upsert_docs", "apply_file_content", "files_pending", "apply_tombstones", "partial_update", "inverted_index"])
def test_documents_are_parsed_once(spark, monkeypatch, name):
    calls, parse = Counter(), queries.docs_of

    def counted(spark, sf):
        calls["n"] += 1
        return parse(spark, sf)

    rows = payload_rows(spark, [FILE % 1, FILE % 2, '{"type":1,"content":"x y"}'])
    bodies = spark.createDataFrame([("https://files.example.com/docs/1", bytearray(b"text one"))], "url string, body binary")
    monkeypatch.setattr(queries, "rows_of", lambda spark, sf: rows)
    monkeypatch.setattr(queries, "docs_of", counted)
    monkeypatch.setattr(queries.driver_tables, "file_bytes", lambda spark, sf: bodies)
    got = queries.QUERIES[name](spark, "none").collect()
    assert calls["n"] == 1
    if name == "apply_file_content":
        assert [(r["doc_id"], r["content"]) for r in got] == [("1", "text one")]
    if name == "files_pending":
        assert [r["message_id"] for r in got] == ["2"]


def test_new_ranges_are_indexed_without_a_lookup_of_their_ids(spark, tmp_path, monkeypatch):
    store = DocumentStore(spark, str(tmp_path / "docs"), slot_width=10)
    made = lambda *ids: documents.from_contract(messages(spark, *[message(message_id=str(i), raw_payload='{"type":1,"content":"word%s"}' % v) for i, v in ids]))
    index, looked = SearchIndex(store, str(tmp_path / "index")), []
    find = store.read_ids
    monkeypatch.setattr(store, "read_ids", lambda ids, state=None: looked.append(1) or find(ids, state))
    store.upsert(made((1, "a"), (2, "a"), (15, "a")))
    store.upsert(made((2, "b")))
    index.update()
    assert not looked
    assert {r["doc_id"] for r in index.match("worda").collect()} == {"1", "15"} and [r["doc_id"] for r in index.match("wordb").collect()] == ["2"]
    store.upsert(made((1, "c"), (25, "a")))
    index.update()
    assert looked and {r["doc_id"] for r in index.match("worda").collect()} == {"15", "25"} and [r["doc_id"] for r in index.match("wordc").collect()] == ["1"]


def test_shard_rows_of_one_row_group_are_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    """A load of a file that a scan reads in one task (cutover, resume_load)."""
    rows(spark, *[row(str(i), id=i) for i in range(1, 401)]).coalesce(1).write.parquet(str(tmp_path / "shard"))
    source = spark.read.schema(C.ddl(C.ROW_FIELDS)).parquet(str(tmp_path / "shard"))
    target = historical.LoadTarget.below(spark, str(tmp_path / "load"))
    judged = historical.run(source, target)
    per_task = Counter(r[0] for r in judged.select(F.input_file_name()).collect()).values()
    assert sum(per_task) == 400 and len(per_task) >= 4 and max(per_task) < 200
    assert target.store.read().count() == 400


def test_counting_merged_documents_reads_ids_only(spark, tmp_path):
    """As resume_load does after its documents were written twice."""
    source = rows(spark, *[row(str(3 * 10**18 + i), id=i) for i in range(1, 9)])
    target = historical.LoadTarget.below(spark, str(tmp_path / "load"))
    historical.run(source.where("id < 5"), target)
    historical.run(source, historical.LoadTarget(target.store, target.dlq_root, historical.VersionedPointer(spark, str(tmp_path / "lost"))))
    counted = target.store.read().agg(F.count(F.lit(1)).alias("n"))
    assert "payloadRaw" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.first()["n"] == 8
    assert sorted(r["messageId"] for r in target.store.read().collect()) == [3 * 10**18 + i for i in range(1, 9)]


def test_updates_of_no_document_leave_nothing_in_a_merge(spark, tmp_path):
    source = rows(spark, row(str(3 * 10**18 + 1), id=1), row(str(3 * 10**18 + 2), id=2))
    target = historical.LoadTarget.below(spark, str(tmp_path / "load"))
    historical.run(source, target)
    ids = [(str(3 * 10**18 + 1), 3 * 10**18 + 1, "text"), (str(3 * 10**18 + 7), 3 * 10**18 + 7, "lost")]
    updates = spark.createDataFrame(ids, "_id string, messageId bigint, content string")
    target.store._append("files", updates.withColumn("contentMeta", F.lit(None).cast(C.META_DDL)))
    got = {r["_id"]: r["payload"]["file"] and r["payload"]["file"]["content"] for r in target.store.read().collect()}
    assert got == {str(3 * 10**18 + 1): "text", str(3 * 10**18 + 2): None}
    assert target.store.read().count() == 2
