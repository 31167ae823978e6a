"""Prefixes, cursors, deliveries, dead letters, reconcile, files, streams."""

import functools
import json
import os
import random
import tempfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import netx, textx
from searchloom.operators import deadletters, delivery, documents, enrich, files, gates, limits, recon, search, stability, upsert, wire
from searchloom.plans import cutover, file_backfill, historical, incremental, reconcile
from searchloom.sinks import docstore, pointer, tables
from searchloom.sinks import letters as letters_
from searchloom.sinks.docstore import ConcurrentWrite, DocumentStore
from searchloom.sinks.pointer import UnreadablePointer, VersionedPointer
from searchloom.sinks.searchindex import SearchIndex
from searchloom.sources import shards, streams
from searchloom.streaming import extraction, indexing
from tests.helpers import message, messages, row, rows


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="searchloom-test-")


# ---- stable prefix, cursors ------------------------------------------------------
def test_everything_behind_a_fresh_row_waits(spark):
    at = {1: 90, 2: 95, 3: 150, 4: 80}
    r = rows(spark, *[row(str(i), id=i, created_unix=t) for i, t in at.items()], row("9", id=9, shard_table="message1", created_unix=1))
    got = {(x["shard_table"], x["id"]) for x in stability.stable_prefix(r, 100).collect()}
    assert got == {("message", 1), ("message", 2), ("message1", 9)}


def test_cursor_moves_forward_only(spark):
    now = spark.createDataFrame([("a", 5), ("b", 7)], "shard_table string, last_id bigint")
    new = spark.createDataFrame([("a", 4), ("b", 9), ("c", 1)], "shard_table string, last_id bigint")
    assert {tuple(r) for r in stability.advance(now, new).collect()} == {("a", 5), ("b", 9), ("c", 1)}


def test_scan_reads_above_each_cursor(spark):
    r = rows(spark, row(id=1), row(id=2), row(id=1, shard_table="message1"), row(id=0, shard_table="message2"))
    got = {(x["shard_table"], x["id"]) for x in shards.scan(r, {"message": 1}).collect()}
    assert got == {("message", 2), ("message1", 1)}


def test_first_descending_arrival(spark):
    seq = [3, 5, 6, 6, 2, 9]
    data = [("s", i, v) for i, v in enumerate(seq)] + [("t", i, i) for i in range(300)]
    df = spark.createDataFrame(data, "shard_table string, arrival bigint, id bigint")
    assert [tuple(r) for r in stability.order_violations(df).collect()] == [("s", 3, 6, 6)]


def test_pointer_compares_before_it_sets(spark, root):
    p = VersionedPointer(spark, f"{root}/p")
    assert p.read() == (0, {})
    assert p.commit(0, {"a": 1}) and not p.commit(0, {"a": 2}) and p.commit(1, {"a": 3})
    assert p.read() == (2, {"a": 3})
    with open(f"{root}/p/000000000003.json", "w"):
        pass  # from a writer of another kind: never step back to an older value
    with pytest.raises(UnreadablePointer):
        p.read()


def test_a_number_is_never_there_before_its_value(spark, root, monkeypatch):
    a, b = VersionedPointer(spark, f"{root}/p"), VersionedPointer(spark, f"{root}/p")
    assert a.commit(0, {"n": 0})
    name, seen = VersionedPointer._name, []

    def late(self, draft, target):
        # another job reads and commits between the write and the naming
        seen.append(b.read())
        monkeypatch.setattr(VersionedPointer, "_name", name)
        assert b.commit(seen[0][0], {"n": "b"})
        name(self, draft, target)

    monkeypatch.setattr(VersionedPointer, "_name", late)
    assert not a.commit(1, {"n": "a"})
    assert seen == [(1, {"n": 0})] and a.read() == (2, {"n": "b"})


def test_old_versions_go(spark, root, monkeypatch):
    monkeypatch.setattr(pointer, "KEPT_VERSIONS", 2)
    p = VersionedPointer(spark, f"{root}/p")
    assert all(p.commit(i, {"n": i}) for i in range(6)) and p.read() == (6, {"n": 5})
    assert len([x for x in os.listdir(f"{root}/p") if x.endswith(".json") and not x.startswith(".")]) == 3


# ---- delivery ----------------------------------------------------------------------
def test_commit_points(spark):
    items = [("t", 0, 100, "transient"), ("t", 0, 101, "ok"), ("t", 1, 200, "ok"), ("t", 1, 201, "dlq_resolved"), ("t", 2, 5, "ok"), ("t", 2, 6, "transient")]
    df = spark.createDataFrame(items, "topic string, partition int, offset bigint, disposition string")
    assert {tuple(r) for r in stability.commit_points(df).collect()} == {("t", 1, 201), ("t", 2, 5)}


@pytest.mark.parametrize(
    ("status", "write", "update"),
    [(200, "ok", "ok"), (201, "ok", "ok"), (400, "permanent", "os_permanent"), (404, "permanent", "doc_not_yet"), (409, "transient", "transient"),
     (413, "permanent", "os_permanent"), (429, "transient", "transient"), (500, "transient", "transient"), (503, "transient", "transient"), (0, "transient", "transient")],
)
def test_status_classes(spark, status, write, update):
    r = spark.range(1).select(delivery.status_class(F.lit(status)).alias("w"), delivery.update_status_class(F.lit(status)).alias("u")).first()
    assert (r["w"], r["u"]) == (write, update)


def test_parent_fails_with_its_children(spark):
    data = [(1, 0, 200), (1, 2, 200), (2, 0, 200), (2, 4, 400), (2, 3, 503), (3, 0, 429), (3, 1, 400)]
    df = spark.createDataFrame(data, "parent_id bigint, sub_seq int, status int")
    got = {r["parent_id"]: (r["ok"], r["status"]) for r in delivery.parent_results(df).collect()}
    assert got == {1: (True, 200), 2: (False, 503), 3: (False, 429)}


def test_retries_end(spark):
    df = spark.createDataFrame([("a", 0, 503), ("b", 10, 503), ("c", 3, 200), ("d", 3, 404), ("e", 1, 400)], "key string, attempts int, status int")
    got = {r["key"]: (r["attempts"], r["state"], r["next_attempt_at"]) for r in delivery.retry_pass(df, 1000, 10, 1, 60).collect()}
    assert got == {"a": (1, "waiting", 1001), "b": (10, "retry_exhausted", None), "c": (4, "ok", None), "d": (4, "waiting", 1008), "e": (2, "os_permanent", None)}
    forever = {r["key"]: r["state"] for r in delivery.retry_pass(df, 1000, None, 1, 60).collect()}
    assert forever["b"] == "waiting"


# ---- limits, dead letters ------------------------------------------------------------
def test_oversize_messages_degrade_then_die(spark):
    big = "x" * 1_000_100
    items = [
        message(message_id="1", raw_payload=json.dumps({"type": 2, "b": big}), raw_excluded=True),
        message(message_id="2", raw_payload=json.dumps({"type": 1, "content": big}), content=big, content_type=1),
        message(message_id="3", raw_payload='{"type":4}'),
    ]
    got = {r["message_id"]: (r["fit"], r["raw_payload"]) for r in limits.degrade_oversize(messages(spark, *items)).collect()}
    assert got == {"1": ("degraded", None), "2": ("oversize", None), "3": ("whole", '{"type":4}')}


def test_document_size_is_that_of_its_json(spark):
    text = "é<b>\n" * 50
    m = messages(spark, message(raw_payload=json.dumps({"type": 1, "content": text}, ensure_ascii=False)))
    d = documents.from_contract(m).withColumn("n", limits.document_bytes())
    r = d.first().asDict(recursive=True)

    def clean(v):
        return {k: clean(x) for k, x in v.items() if x is not None} if isinstance(v, dict) else v

    body = clean({k: v for k, v in r.items() if k not in ("_id", "payloadRaw", "n")})
    size = len(json.dumps(body, ensure_ascii=False, separators=(",", ":")).encode()) + len(r["payloadRaw"].encode())
    assert r["n"] == size
    docs = documents.from_contract(m)
    assert limits.oversize_documents(docs, size - 1).count() == 1 and limits.oversize_documents(docs, size).count() == 0


def test_letters_drop_or_cut_long_payloads(spark):
    n = C.MAX_DLQ_PAYLOAD_BYTES
    r = rows(spark, row("1", b"y" * (n + 1), id=1), row("2", b"y" * n, id=2)).withColumn("reason", F.lit(C.PRODUCER_UNPARSEABLE))
    got = {x["message_id"]: x for x in deadletters.producer_letters(r).collect()}
    assert got["1"]["raw_payload"] is None and "payload_truncated:true" in got["1"]["detail"]
    assert len(got["2"]["raw_payload"]) == n and got["2"]["detail"] is None
    ddl = "reason string, topic string, partition int, offset bigint, key binary, value binary, status int, error string"
    items = [(C.INDEXER_PERMANENT, "t", 0, 1, b"k", bytearray(n + 1), 400, "bad"), (C.INDEXER_SCHEMA, "t", 0, 2, b"k", bytearray(3), 400, "bad")]
    got = {x["offset"]: x for x in deadletters.indexer_letters(spark.createDataFrame(items, ddl)).collect()}
    assert got[1]["value"] is None and got[1]["payload_truncated"] and got[1]["detail"].startswith("bad; value left out: 700001 bytes")
    assert (got[2]["status"], got[2]["detail"], len(got[2]["value"])) == (0, "", 3)
    ddl = "reason string, topic string, partition int, offset bigint, key binary, value binary, message_id string, url string, extension string, size bigint, error string"
    out = deadletters.file_letters(spark.createDataFrame([("r", "t", 0, 1, b"k", bytearray(n + 5), "m", "u", "e", 1, "x")], ddl)).first()
    assert len(out["value"]) == n and out["payloadTruncated"]


def test_letters_are_stored_once(spark):
    ddl = "`table` string, id bigint, message_id string, created_at bigint, reason string"
    df = spark.createDataFrame([("a", 1, "m", 5, "first"), ("b", 1, "m", 5, "second"), ("a", 2, "", 6, "x"), ("a", 3, "", 7, "x")], ddl)
    got = {r["dedup_key"]: r["reason"] for r in deadletters.first_per_key(df).collect()}
    assert got == {"m": "first", "a:2": "x", "a:3": "x"}
    assert deadletters.new_letters(df, df).count() == 0
    assert [r[0] for r in deadletters.window_ids(df, 5, 7).collect()] == ["m"]
    assert deadletters.window_count(df, 6, 7).first()[0] == 2


# ---- reconcile -------------------------------------------------------------------------
@pytest.mark.parametrize(
    ("source", "docs", "raw", "dlq", "expected", "diff", "verdict"),
    [
        (1000, 1000, 0, 0, 1000, 0, "ok"), (1000, 997, 9, 3, 997, 0, "ok"), (1000, 990, 0, 0, 1000, -10, "mismatch"),
        (1000, 1005, 0, 0, 1000, 5, "mismatch"), (500, 485, 1, 10, 490, -5, "mismatch"), (5, 5, 0, 6, None, None, "invalid"),
        (5, 5, 6, 0, None, None, "invalid"), (-1, 0, 0, 0, None, None, "invalid"), (0, 0, 0, 0, 0, 0, "ok"),
    ],
)
def test_count_verdicts(spark, source, docs, raw, dlq, expected, diff, verdict):
    r = recon.reconcile(
        spark.createDataFrame([(source,)], "source_rows bigint"),
        spark.createDataFrame([(docs, raw)], "doc_count bigint, raw_excluded bigint"),
        spark.createDataFrame([(dlq,)], "dlq_keys bigint"),
    ).first()
    assert (r["expected"], r["diff"], r["verdict"]) == (expected, diff, verdict)


def test_sample_comparison(spark):
    source = rows(
        spark,
        row("10", '{"type":1,"content":"a","visibles":["x","y"],"space_id":"s"}', id=1),
        row("20", '{"type":1,"content":"a"}', id=2),
        row("30", '{"type":1,"content":"a"}', id=3),
        row("40", "cipher", id=4, signal=1),
        row("", '{"type":1}', id=5),
        row("007", '{"type":1,"content":"a"}', id=6),
    )
    docs = documents.documents(enrich.contract_rows(enrich.with_route(source), ["body"])).where("_id <> '20'")
    docs = docs.withColumn("visibles", F.when(F.col("_id") == "10", F.reverse("visibles")).when(F.col("_id") == "40", F.array(F.lit("z"))))
    docs = docs.withColumn("channelId", F.when(F.col("_id") == "30", "zz").otherwise(F.col("channelId"))).withColumn(
        "messageSeq", F.when(F.col("_id") == "30", 99).otherwise(F.col("messageSeq"))
    )
    skip = spark.createDataFrame([("10",)], "message_id string")
    none = skip.where("false")
    expected = recon.comparable_sample(recon.expected_fields(source), none, 0, 2**40, None)
    details = {(r["message_id"], r["field"]) for r in recon.compare(expected, docs).collect()}
    # an id that is not in its normal form is looked up as written, and reported missing
    assert details == {("20", "_doc"), ("30", "channelId"), ("30", "messageSeq"), ("007", "_doc")}
    h = recon.sample_health(expected, recon.compare(expected, docs)).first()
    assert tuple(h) == (5, 2, 1)
    cut = recon.comparable_sample(recon.expected_fields(source), skip, 0, 2**40, 2).collect()
    assert sorted(r["message_id"] for r in cut) == ["007", "20"]


# ---- files -------------------------------------------------------------------------------
def test_extension_rules(spark):
    df = spark.createDataFrame([("PDF", "a.txt"), ("", "a.TXT"), (None, "a"), (".Zip", "x"), ("", ".env"), (" doc ", "q.x")], "e string, n string")
    got = [tuple(r) for r in df.select(textx.extension_field_first(F.col("e"), F.col("n")), textx.extension_name_first(F.col("e"), F.col("n"))).collect()]
    assert got == [(".pdf", "txt"), (".txt", "txt"), ("", ""), (".zip", ".zip"), (".env", ""), (".doc", "x")]


@pytest.mark.parametrize("limit", range(0, 12))
def test_cut_ends_on_a_character(spark, limit):
    text = "aé会😀b"
    got = spark.createDataFrame([(text,)], "t string").select(textx.cut_utf8(F.col("t"), limit)).first()[0]
    want = ""
    for ch in text:
        if len((want + ch).encode()) > limit:
            break
        want += ch
    assert got == want


def test_addresses(spark):
    urls = {
        "https://cdn.x.com/a": True, "HTTPS://CDN.x.com:443/a": True, "http://cdn.x.com/a": False, "https://evil.com/": False, "https://cdn.x.com@evil.com/": False,
        "https://u:p@cdn.x.com/": True, "": False, "https://": False, "https://cdn.x.com:8x/": False, "//cdn.x.com/": False, "https://cdn.x.com\n/": False,
    }
    df = spark.createDataFrame(list(urls.items()), "u string, want boolean")
    assert [r["u"] for r in df.where(netx.url_allowed(F.col("u"), ["cdn.x.com"]) != F.col("want")).collect()] == []
    ips = {
        "10.1.2.3": True, "172.16.0.1": True, "172.32.0.1": False, "192.168.1.1": True, "127.0.0.1": True, "169.254.169.254": True, "100.64.0.1": True,
        "100.128.0.1": False, "0.0.0.0": True, "8.8.8.8": False, "256.1.1.1": True, "010.0.0.1": True, "x": True, "": True, "::1": True, "::": True,
        "fe80::1": True, "fd00::1": True, "2001:4860::8888": False, "::ffff:10.0.0.1": True, "::ffff:8.8.8.8": False, "ff02::1": True,
    }
    df = spark.createDataFrame(list(ips.items()), "u string, want boolean")
    assert [r["u"] for r in df.where(netx.ip_blocked(F.col("u")) != F.col("want")).collect()] == []


def fake_extractor():
    # an inner function travels to the workers by value
    def run(batches):
        for b in batches:
            out = pd.DataFrame({"url": b["url"], "content": [x.decode() for x in b["body"]], "error_kind": None, "extract_ms": 5})
            for word, kind in [("locked", "encrypted"), ("slow", "extract_timeout"), ("odd", "extract_error")]:
                hit = out["content"] == word
                out.loc[hit, "error_kind"], out.loc[hit, "content"] = kind, None
            yield out

    run.label = "fake/1"
    return run


def test_first_failing_check_decides(spark):
    h = "https://h/"
    ddl = "message_id string, url string, name string, extension string, size bigint"
    files_ = [
        ("1", h + "1", "a.zip", "", 99999999), ("2", "http://h/2", "a.txt", "", 99999999), ("3", "http://h/3", "a.txt", "", 1), ("4", h + "gone", "a.txt", "", 1),
        ("5", h + "5", "a.txt", "", 1), ("6", h + "6", "a.txt", "", 1), ("7", h + "7", "a.pdf", "", 1), ("8", h + "8", "a.pdf", "", 1), ("9", h + "9", "a.doc", "", 1),
        ("10", h + "10", "a", "", 1), ("11", h + "11", "p.html", "", None), ("12", h + "5", "b.txt", "", 1), ("13", h + "13", "a.txt", "", 1),
    ]
    bodies = {"5": b"plain", "6": " 　\n".encode(), "7": b"locked", "8": b"slow", "9": b"from doc", "10": b"odd", "11": b"<p>a</p><script>no</script><b>b &amp; c</b>", "13": b"x" * 40}
    store = spark.createDataFrame([(h + k, bytearray(v)) for k, v in bodies.items()], "url string, body binary")
    out = files.extract_files(spark.createDataFrame(files_, ddl), store, ["h"], max_file_bytes=100, max_content_bytes=8, extractor=fake_extractor())
    got = {r["message_id"]: (r["outcome"], r["content"]) for r in out.collect()}
    assert got == {
        "1": ("blacklist_ext", None), "2": ("oversize", None), "3": ("invalid_url", None), "4": ("download_failed", None), "5": ("ok", "plain"),
        "6": ("empty_extract", None), "7": ("encrypted", None), "8": ("extract_timeout", None), "9": ("ok", "from doc"), "10": ("extract_error", None),
        "11": ("ok", "a\nb & c"), "12": ("ok", "plain"), "13": ("ok", "x" * 8),
    }
    meta = {r["message_id"]: (r["extractor"], r["truncated"]) for r in out.where("outcome = 'ok'").collect()}
    assert meta["9"] == ("fake/1", False) and meta["13"] == (files.NATIVE_LABEL, True)
    small = files.extract_files(spark.createDataFrame(files_, ddl), store, ["h"], max_file_bytes=20)
    assert {r["message_id"]: r["outcome"] for r in small.collect()}["13"] == "oversize"
    gate = files.backfill_gate(out).first()
    assert (gate["scanned"], gate["extracted"], gate["verdict"]) == (13, 5, "too_many_dead_letters")


def test_word_counts_match_a_counter(spark):

    m = messages(spark, message(message_id="1", raw_payload=json.dumps({"type": 1, "content": "The the cat. 会议室 cat-THE 9"})))
    got = {(r["token"], r["tf"]) for r in search.inverted_index(documents.from_contract(m)).collect()}
    assert got == set(Counter(["the", "the", "cat", "会议", "议室", "cat", "the", "9"]).items())


# ---- stream values --------------------------------------------------------------------------
def test_decoding_is_strict(spark):
    good = '{"schema_version":2,"message_id":"1","raw_payload":{"type":1.0,"a":[1]},"visibles":["a",null],"created_at":5}'
    values = [
        good, '{"schema_version":1,"message_id":"1"}', "junk", '{"schema_version":2,"message_id":1}', '{"schema_version":2.0}', '{"schema_version":2,"visibles":"a"}',
        '{"schema_version":2,"raw_excluded":1}', good + " x", '{"schema_version":2,"content":null,"raw_payload":"{\\"type\\":1}"}', "{}",
        '{"schema_version":2,"raw_payload":null}',
    ]
    df = spark.createDataFrame([("t", 0, i, b"k", v.encode()) for i, v in enumerate(values)], C.ddl(C.STREAM_FIELDS))
    got = {r["offset"]: r for r in wire.decode(df).collect()}
    assert [i for i in got if got[i]["reason"] is None] == [0, 8, 10]
    assert got[0]["raw_payload"] == '{"type":1.0,"a":[1]}' and got[0]["visibles"] == ["a", ""]
    # a payload sent as text stays text: it must not pass for an object
    assert got[8]["raw_payload"] == '"{\\"type\\":1}"' and got[10]["raw_payload"] == "null"
    why = {r["offset"]: r["reason"] for r in wire.judged(df).collect()}
    assert (why[8], why[10]) == (C.INDEXER_UNTRUSTED, C.INDEXER_UNTRUSTED)


def test_payloads_keep_their_text_in_any_field_order(spark):
    texts = [
        '{"type":1.0,"n":9007199254740993,"content":"x"}', '{ "type" : 1 , "a" : [ 1, {"raw_payload":{"b":"}"}} ] }', '{"type":1,"content":"a \\"quoted\\" ,\\"raw_payload\\": {"}',
        '{"type":14,"content":[{"raw_payload":{"x":1}}],"raw_payload":{"y":[2]}}', '{"raw_payload":{"type":1}}', '{"type":1,"content":"\\\\"}',
    ]
    around = [
        '{"schema_version":2,"message_id":"1","raw_payload":%s,"visibles":["a"],"created_at":5}', '{"raw_payload":%s,"schema_version":2}',
        ' { "schema_version" : 2 , "raw_payload" :\t%s\n, "content":"raw_payload" } ', '{"schema_version":2,"content":"raw_payload","raw_payload":%s}',
        '{"schema_version":2,"content":"}],\\"raw_payload\\":{","raw_payload":%s , "source":"s"}', '{"raw_payload":{"old":1},"schema_version":2,"raw_payload":%s,"message_id":"2"}',
        '{"schema_version":2,"raw_payload":%s}  ', '{"extra":{"raw_payload":{"type":9}},"schema_version":2,"raw_payload":%s,"more":[{"raw_payload":1}]}',
    ]
    values = [a % t for a in around for t in texts]
    df = spark.createDataFrame([("t", 0, i, b"k", v.encode()) for i, v in enumerate(values)], C.ddl(C.STREAM_FIELDS))
    got = {r["offset"]: (r["reason"], r["raw_payload"]) for r in wire.decode(df).collect()}
    assert [got[i] for i in range(len(values))] == [(None, t) for _ in around for t in texts]


def test_messages_survive_the_wire(spark):
    m = messages(
        spark,
        message(message_id="1", raw_payload='{"type":2.0,"n":9007199254740993,"t":"é\\n\\""}', visibles=["a"], space_id="s", raw_excluded=True),
        message(message_id="2", content='q"\n', content_type=1),
    )
    back = {r["message_id"]: r for r in wire.decode(wire.encode(m, "t")).collect()}
    assert back["1"]["raw_payload"] == '{"type":2.0,"n":9007199254740993,"t":"é\\n\\""}' and back["1"]["visibles"] == ["a"]
    assert back["2"]["content"] == 'q"\n' and back["2"]["raw_payload"] is None


# ---- jobs -------------------------------------------------------------------------------------
SUITE = [
    row("3000000000000000001", '{"type":1,"content":"今天的需求评审会议改到下午三点"}', id=1),
    row("3000000000000000002", '{"type":99,"content":"s","visibles":["u_admin","u_alice"]}', id=2),
    row("3000000000000000003", "ciphertext", id=3, setting=32),
    row("3000000000000000004", '{"type":2,"url":"u"}', id=1, shard_table="message1"),
    row("3000000000000000005", "{not valid json", id=2, shard_table="message1"),
    row("3000000000000000006", '{"type":99,"visibles":[]}', id=3, shard_table="message1"),
]


def test_tick_publishes_then_moves_the_cursor(spark, root):
    p = VersionedPointer(spark, f"{root}/cursors")
    r = rows(spark, *SUITE, row("3000000000000000007", id=9, created_unix=1700009000), row("3000000000000000008", id=10))
    moved = incremental.run_tick(r, p, root, 1700009000, 600)
    assert moved == {"message": 3, "message1": 3}
    main = {x["key"].decode()[-1]: json.loads(bytes(x["value"])) for x in incremental.main_records(spark, root, p).collect()}
    assert sorted(main) == list("1234")
    assert main["3"]["raw_excluded"] and "raw_payload" not in main["3"]
    assert main["4"]["raw_excluded"] and main["4"]["raw_payload"] == {"type": 2, "url": "u"}
    dlq = {x["message_id"][-1]: x["reason"] for x in incremental.dead_records(spark, root, p).collect()}
    assert dlq == {"5": C.PRODUCER_UNPARSEABLE, "6": C.PRODUCER_UNTRUSTED}
    # the held-back rows follow once the fresh one has aged
    assert incremental.run_tick(r, p, root, 1700009700, 600) == {"message": 10, "message1": 3}
    assert incremental.main_records(spark, root, p).count() == 6


def test_failed_publish_leaves_the_cursor(spark, root, monkeypatch):
    p = VersionedPointer(spark, f"{root}/cursors")

    def fail(df, path, run):
        if path.endswith("/dlq"):
            raise OSError("no space")
        return append(df, path, run)

    append = tables.append_run
    monkeypatch.setattr(tables, "append_run", fail)
    with pytest.raises(OSError):
        incremental.run_tick(rows(spark, *SUITE), p, root, 1700009000, 600)
    assert p.read() == (0, {})
    monkeypatch.undo()
    incremental.run_tick(rows(spark, *SUITE), p, root, 1700009000, 600)
    # the records of the failed tick are there twice, and seen once
    assert incremental.main_records(spark, root, p).count() == 4 < spark.read.parquet(f"{root}/main").count()
    assert p.read()[1]["cursors"] == {"message": 3, "message1": 3}
    with pytest.raises(gates.GateError):
        incremental.run_tick(rows(spark, *SUITE), p, root, 1700009000, 0)


def test_of_racing_ticks_each_record_is_seen_once(spark, root, monkeypatch):
    monkeypatch.setattr(incremental, "RUNS_IN_POINTER", 1)
    p, commit, others = VersionedPointer(spark, f"{root}/cursors"), VersionedPointer.commit, [True]

    def late(self, expected, value):
        if others:
            others.clear()  # another tick over more rows is faster
            assert incremental.run_tick(rows(spark, *SUITE, row("3000000000000000008", id=10)), p, root, 1700009000, 600) == {"message": 10, "message1": 3}
        return commit(self, expected, value)

    monkeypatch.setattr(VersionedPointer, "commit", late)
    assert incremental.run_tick(rows(spark, *SUITE), p, root, 1700009000, 600) == {"message": 10, "message1": 3}
    seen = lambda: sorted(x["key"].decode()[-1] for x in incremental.main_records(spark, root, p).collect())
    assert seen() == list("12348") and incremental.dead_records(spark, root, p).count() == 2
    # long lists of runs move to files of their own
    for i in (11, 12, 13):
        incremental.run_tick(rows(spark, row(f"300000000000000000{i - 4}"[-19:], id=i)), p, root, 1700009000, 600)
    state = p.read()[1]
    assert len(state["folded"]) == 2 and len(state["runs"]) == 0 and len(seen()) == 8


def test_jobs_count_while_they_write(spark, root):
    p, tick, load = VersionedPointer(spark, f"{root}/cursors"), Observation(), Observation()
    incremental.run_tick(rows(spark, *SUITE), p, root, 1700009000, 600, counters=tick)
    assert tick.get == {"items": 6, "ok": 4, C.PRODUCER_UNPARSEABLE: 1, C.PRODUCER_UNTRUSTED: 1, C.PRODUCER_OVERSIZE: 0}
    target = historical.LoadTarget.below(spark, f"{root}/load")
    historical.run(rows(spark, *SUITE), target, load)
    letters = Counter(r["reason"] for r in historical.letters(spark, target).collect())
    assert load.get == {"items": 6, "ok": 4, "raw_excluded": 3, **{r: letters[r] for r in (C.LOAD_PARSE, C.LOAD_CONVERT, C.LOAD_REJECT)}}
    records = wire.encode(messages(spark, message(message_id="1", raw_payload='{"type":4}'), message(message_id="x"), message(message_id="2", schema_version=1)), "t")
    records.selectExpr("topic", "0 AS partition", "0L AS offset", "key", "value").write.parquet(f"{root}/stream")
    seen = []
    store = DocumentStore(spark, f"{root}/docs")
    indexing.start(streams.file_stream(spark, f"{root}/stream"), store, f"{root}/letters", f"{root}/cp", report=lambda n, counts: seen.append((n, counts))).awaitTermination()
    assert seen == [(0, {"items": 3, "ok": 1, C.INDEXER_SCHEMA: 1, C.INDEXER_UNTRUSTED: 0, C.INDEXER_PERMANENT: 1})]


def test_letters_are_looked_up_in_their_folders(spark, root, monkeypatch):
    ddl = "dedup_key string, reason string, `table` string, id bigint, message_id string, payload binary, created_at bigint"
    store = letters_.LetterStore(spark, f"{root}/dlq", ddl, buckets=8)
    rows_ = lambda *ids: spark.createDataFrame([("r", "t", i, str(i) if i % 5 else "", b"p", i) for i in ids], "reason string, `table` string, id bigint, message_id string, payload binary, created_at bigint")
    store.append(rows_(*range(1, 40)), "a")
    for scanned in (1000, 0):
        monkeypatch.setattr(letters_, "SCANNED_KEYS", scanned)
        store.append(rows_(3, 40 + (scanned > 0), 5, 3), "b")  # repeats, a new key, and one without an id
        keys = rows_(7).select(F.lit("7").alias("dedup_key")).withColumn("bucket", store._bucket())
        found = store.stored_keys(keys)
        assert {r.dedup_key for r in found.collect()} >= {"7"}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan and ("EqualTo(dedup_key,7)" in plan) == (scanned > 0)
    got = sorted(r.dedup_key for r in store.read().collect())
    assert got == sorted([str(i) if i % 5 else f"t:{i}" for i in range(1, 40)] + ["41", "t:40"])
    store.append(rows_(), "c")
    assert store.read().count() == 41


def test_load_reconcile_and_cutover(spark, root):
    source = rows(spark, *SUITE)
    target = historical.LoadTarget.below(spark, root)
    historical.run(source, target)
    again = historical.LoadTarget(target.store, target.dlq_root, VersionedPointer(spark, f"{root}/other"))
    historical.run(source, again)  # as after a lost cursor
    docs, dead = target.store.read(), historical.letters(spark, target)
    assert docs.count() == 4
    assert {(r["message_id"][-1], r["reason"]) for r in dead.collect()} == {("5", C.LOAD_PARSE), ("6", C.LOAD_CONVERT)}
    report = reconcile.report(source, docs, dead, 0, 2**40)
    assert report.first()["healthy"]
    alias = cutover.ReadAlias(spark, f"{root}/alias")
    assert alias.publish("one", report, docs) and alias.publish("two", report, docs) and alias.current() == "two"
    assert alias.rollback() and alias.current() == "one"
    bad = reconcile.report(source, docs.where("_id <> '3000000000000000001'"), dead, 0, 2**40)
    with pytest.raises(gates.GateError):
        alias.publish("three", bad, docs)
    with pytest.raises(gates.GateError):
        alias.publish("three", report, docs.drop("subSeq"))
    assert alias.current() == "one"


def _doc(spark, id_, kind=4, text=None):
    body = f'{{"type":{kind},"content":"{text}"}}' if text else f'{{"type":{kind}}}'
    return documents.from_contract(messages(spark, message(message_id=str(id_), raw_payload=body)))


def _ids(store):
    return sorted((r["messageId"], r["payload"]["type"]) for r in store.read().collect())


def _text(store, id_):
    file = store.read().where(f"_id = '{id_}'").first()["payload"]["file"]
    return file and (file["content"], file["contentMeta"] and file["contentMeta"]["status"])


def _update(spark, *rows):
    ddl = f"_id string, content string, contentMeta {C.META_DDL}"
    meta = lambda status: None if status is None else (7, "x", None, None, status, None)
    return spark.createDataFrame([(i, text, meta(status)) for i, text, status in rows], ddl)


def test_small_batches_append_deltas(spark, root):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    for i in range(10):
        store.upsert(_doc(spark, 100 * (i % 2) + i).unionByName(_doc(spark, 50, 3 if i == 9 else 4)))
    state = store.state()
    assert len(state.log) == 10 and not state.bases and state.contract == C.CONTRACT_VERSION
    files = lambda: {f for f in store.read().inputFiles()}
    before = files()
    store.upsert(_doc(spark, 5))
    assert len(files()) == len(before) + 1 and before < files()  # one file more, all others as they were
    want = sorted([(50, 3), (5, 4), *[(100 * (i % 2) + i, 4) for i in range(10)]])
    assert _ids(store) == want
    assert store.compact() == [0, 1] and _ids(store) == want
    state = store.state()
    assert set(state.bases) == {"0", "1"} and state.log == [] and len(files()) == 2
    # a range of one layer is read as it lies there
    assert "Join" not in store.read()._jdf.queryExecution().toString()
    store.check_stored()


def test_layers_keep_extracted_text(spark, root):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    gone = lambda *rows: sorted(r["_id"] for r in store.update_files(_update(spark, *rows)).collect())
    store.upsert(_doc(spark, 1, 8).unionByName(_doc(spark, 2, 8)))
    assert gone(("1", "one", None), ("9", "nobody's", None), ("x", "no number", None)) == ["9", "x"]
    store.upsert(_doc(spark, 1, 2))
    assert _text(store, 1) == ("one", None) and _text(store, 2) == (None, None)
    assert gone(("1", None, "unextractable"), ("2", "two", "s")) == []
    for _ in range(2):
        assert _text(store, 1) == ("one", "unextractable") and _text(store, 2) == ("two", "s")
        store.compact()
    store.upsert(_doc(spark, 2, 8))
    gone(("2", "newer", None))
    assert _text(store, 2) == ("newer", "s") and _ids(store) == [(1, 2), (2, 8)]


def test_folding_layers_is_a_chain_of_joins(spark):
    rng = random.Random(4)
    base = documents.from_contract(messages(spark, *[message(message_id=str(i), raw_payload='{"type":8,"name":"n"}') for i in range(30)]))
    base = tables.staged(base, "chain").withColumn("version", F.lit(0))
    docs = old = None
    updates, none = _update(spark), _update(spark)
    updates = updates.withColumn("seq", F.lit(0).cast("bigint"))
    old = base.drop("version").limit(0)
    docs = old.withColumn("seq", F.lit(0).cast("bigint"))
    for seq in range(1, 6):
        ids = [str(i) for i in range(30) if rng.random() < 0.5]
        if seq in (1, 3):
            own = {i: (f"own{seq}", (seq, f"e{seq}", None, None, None, "r")) for i in ids if rng.random() < 0.5}
            new = base.where(F.col("_id").isin(ids)).drop("version").withColumn("messageSeq", F.lit(seq).cast("bigint"))
            brought = spark.createDataFrame([(i, t, m) for i, (t, m) in own.items()], f"_id string, content string, contentMeta {C.META_DDL}")
            new = tables.staged(upsert.partial_update(new, brought), "chain")
            old = tables.staged(upsert.upsert(old, new), "chain")
            docs = docs.unionByName(new.withColumn("seq", F.lit(seq).cast("bigint")))
        else:
            known = [r[0] for r in old.select("_id").collect()]
            rows = [(i, rng.choice([None, f"t{seq}"]), rng.choice([None, f"s{seq}"])) for i in ids if i in known]
            u = tables.staged(_update(spark, *rows), "chain")
            old = tables.staged(upsert.partial_update(old, u), "chain")
            updates = updates.unionByName(u.withColumn("seq", F.lit(seq).cast("bigint")))
    as_text = lambda df: sorted(map(str, df.select(*C.DOC_COLUMNS).collect()))
    assert as_text(upsert.folded(docs, updates)) == as_text(old) and old.count() > 20
    assert none.count() == 0


def test_writers_never_undo_each_other(spark, root, monkeypatch):
    a, b = (DocumentStore(spark, f"{root}/docs", slot_width=100) for _ in range(2))
    a.upsert(_doc(spark, 5))
    written, others = DocumentStore._written_slots, [_doc(spark, 205), _doc(spark, 7, 3), _doc(spark, 6, 3)]

    def late(self, folder):
        # while the files of a are written, b publishes
        if self is a and others:
            b.upsert(others.pop(0))
        return written(self, folder)

    monkeypatch.setattr(DocumentStore, "_written_slots", late)
    a.upsert(_doc(spark, 6))
    reader = a.read()
    a.upsert(_doc(spark, 9))
    assert _ids(a) == [(5, 4), (6, 4), (7, 3), (9, 4), (205, 4)]
    # a compaction beside a writer and a reader: the delta in between stays, the reader's files too
    assert a.compact(slots=[0]) == [0]
    assert _ids(a) == [(5, 4), (6, 3), (7, 3), (9, 4), (205, 4)] and len(a.state().log) == 2
    assert sorted(r["_id"] for r in reader.collect()) == ["205", "5", "6"]


def test_of_two_compactions_one_counts(spark, root, monkeypatch):
    a, b = (DocumentStore(spark, f"{root}/docs", slot_width=100) for _ in range(2))
    for i in (1, 2, 101):
        a.upsert(_doc(spark, i))
    a.upsert(_doc(spark, 102))
    written, first = DocumentStore._written_slots, [True]

    def late(self, folder):
        if self is a and first:
            first.clear()
            assert b.compact(slots=[1]) == [1]
            b.upsert(_doc(spark, 103))
        return written(self, folder)

    monkeypatch.setattr(DocumentStore, "_written_slots", late)
    assert a.compact() == [0] and _ids(a) == [(i, 4) for i in (1, 2, 101, 102, 103)]


def test_drops_cover_what_was_written_before(spark, root):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    store.upsert(functools.reduce(DataFrame.unionByName, [_doc(spark, i, 8) for i in (5, 95, 105, 195, 205)]))
    store.update_files(_update(spark, ("95", "text", None), ("105", "text", None)))
    store.drop(90, 200)
    assert _ids(store) == [(5, 8), (205, 8)]
    assert [r["_id"] for r in store.update_files(_update(spark, ("95", "late", None), ("5", "five", None))).collect()] == ["95"]
    store.upsert(_doc(spark, 95, 4))
    assert _ids(store) == [(5, 8), (95, 4), (205, 8)] and _text(store, 95) is None
    # the range in the middle is gone, the last one still is its first delta
    assert store.compact() == [0, 1] and [e["slots"] for e in store.state().log] == [[2]] and set(store.state().bases) == {"0"}
    assert _ids(store) == [(5, 8), (95, 4), (205, 8)] and _text(store, 5) == ("five", None)


def test_file_updates_merge_no_layers(spark, root, monkeypatch):
    # every update of a stream asks which documents are there: the layers of a range are not merged for that
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    for ids in ((1, 2), (1, 3), (150, 151)):
        store.upsert(functools.reduce(DataFrame.unionByName, [_doc(spark, i, 8) for i in ids]))
    store.update_files(_update(spark, ("1", "one", None)))
    store.drop(2, 3)
    store.drop(151, 152)
    monkeypatch.setattr(docstore, "_merged", lambda docs, updates: pytest.fail("layers were merged"))
    rows = [("1", "newer", None), ("2", "dropped", None), ("3", "three", None), ("4", "none", None), ("151", "dropped", None), ("x", "no number", None), ("950", "no range", None)]
    assert sorted(r["_id"] for r in store.update_files(_update(spark, *rows)).collect()) == ["151", "2", "4", "950", "x"]
    assert store.update_files(_update(spark)).collect() == []
    monkeypatch.undo()
    assert _text(store, 1) == ("newer", None) and _text(store, 3) == ("three", None)
    store.upsert(_doc(spark, 2, 8))
    assert store.update_files(_update(spark, ("2", "there again", None))).collect() == [] and _text(store, 2) == ("there again", None)


def test_id_lookups_open_touched_ranges_only(spark, root, monkeypatch):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    store.upsert(functools.reduce(DataFrame.unionByName, [_doc(spark, 100 * k + i) for k in range(6) for i in (1, 2)]))
    store.upsert(_doc(spark, 101, 3))
    ids = spark.createDataFrame([("101",), ("402",), ("999",), ("2-rt1",), ("x",), (None,), ("101",)], "doc_id string")
    for scanned in (1000, 0):
        monkeypatch.setattr(docstore, "SCANNED_IDS", scanned)
        found = store.read_ids(ids)
        assert sorted((r["_id"], r["payload"]["type"]) for r in found.collect()) == [("101", 3), ("402", 4)]
        opened = {f.split("slot=")[1].split("/")[0] for f in found.inputFiles() if "slot=" in f}
        assert opened == {"0", "1", "4"}
        assert "PushedFilters: [" in found._jdf.queryExecution().toString() and "messageId" in found._jdf.queryExecution().toString()


def test_index_follows_the_table(spark, root):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    index = SearchIndex(store, f"{root}/index")
    found = lambda q, field=None: sorted((int(r["doc_id"]), r["words"], r["tf"]) for r in index.match(q, field).collect())
    assert not index.update() and found("anything") == []
    store.upsert(_doc(spark, 1, 1, "the cat and The dog").unionByName(_doc(spark, 2, 1, "会议室 cat")).unionByName(_doc(spark, 150, 1, "dog")))
    assert index.update() and not index.update()
    assert found("THE cat") == [(1, 2, 3), (2, 1, 1)] and found("会议") == [(2, 1, 1)] and found("室") == []
    assert found("cat", "payload.file.content") == [] and found("cat", "payload.text.content") == [(1, 1, 1), (2, 1, 1)]
    store.upsert(_doc(spark, 1, 1, "only dogs").unionByName(_doc(spark, 3, 8)))
    store.update_files(_update(spark, ("3", "a file about a cat", None)))
    index.update()
    for _ in range(2):
        assert found("cat the") == [(2, 1, 1), (3, 1, 1)] and found("dogs") == [(1, 1, 1)]
        assert {tuple(r) for r in index.frequencies("cat dogs a nothing").collect()} == {("cat", 2), ("dogs", 1), ("a", 1)}
        index.compact()
    assert len(index.pointer.read()[1]["segments"]) == 1
    store.upsert(_doc(spark, 2, 1, "gone"))
    store.compact()  # the log between is gone: the range is indexed as a whole
    store.drop(100, 200)
    index.update()
    assert found("cat") == [(3, 1, 1)] and found("gone") == [(2, 1, 1)] and found("dog") == []
    index.compact()
    assert found("cat gone dog") == [(2, 1, 1), (3, 1, 1)]


def test_a_search_opens_the_folders_of_its_words(spark, root):
    store = DocumentStore(spark, f"{root}/docs")
    index = SearchIndex(store, f"{root}/index")
    store.upsert(functools.reduce(DataFrame.unionByName, [_doc(spark, i, 1, f"word{i} and word{i + 1}") for i in range(1, 30)]))
    index.update()
    opened = index.match("word3 word8").inputFiles()
    buckets = {f.split("bucket=")[1].split("/")[0] for f in opened}
    assert len(opened) == len(buckets) <= 2 and all("/postings/" in f for f in opened)
    assert "PushedFilters: [In(token" in index.postings("word3 word8")._jdf.queryExecution().toString()


def test_stored_files_are_read_up_to_their_limit(spark, root):
    os.makedirs(f"{root}/mirror/docs")
    for name, body in (("docs/a%20b.txt", b"text"), ("docs/large.txt", b"x" * (21 << 20)), ("docs/none.txt", b"\n")):
        with open(f"{root}/mirror/{name}", "wb") as file:
            file.write(body)
    bodies = streams.stored_files(spark, f"{root}/mirror", address=streams.address_below(f"{root}/mirror", "https://h"))
    found = {r["url"]: r["n"] for r in bodies.select("url", F.octet_length("body").alias("n")).collect()}
    assert found == {"https://h/docs/a b.txt": 4, "https://h/docs/large.txt": None, "https://h/docs/none.txt": 1}
    # the limit is the source's: neither leg opens the content of a large file
    plan = bodies._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length" in plan and "ReadSchema: struct<path:string,length:bigint>" in plan
    wanted = spark.createDataFrame([(str(i), u, None, "txt", None) for i, u in enumerate(sorted(found))], "message_id string, url string, name string, extension string, size bigint")
    out = {r["url"]: r["outcome"] for r in files.extract_files(tables.staged(wanted, "wanted"), bodies, ["h"]).collect()}
    assert out == {"https://h/docs/a b.txt": "ok", "https://h/docs/large.txt": "oversize", "https://h/docs/none.txt": "empty_extract"}


def test_stored_files_are_checked_and_cleaned(spark, root):
    store = DocumentStore(spark, f"{root}/docs", slot_width=100)
    store.upsert(_doc(spark, 5))
    store.upsert(_doc(spark, 6))
    store.compact()
    assert store.clean() == [] and len(store.clean(older_than_s=-60)) == 2 and store.read().count() == 2
    store.upsert(_doc(spark, 7))
    folder = store.state().log[-1]["folder"]
    # files of an older layout, put there behind our back
    old = store.read().drop("subSeq")
    tables.staged(old, "old").coalesce(1).write.mode("overwrite").parquet(f"{root}/docs/{folder}/slot=0")
    with pytest.raises(gates.GateError):
        store.check_stored()
    with pytest.raises(gates.GateError):
        indexing.start(None, store, f"{root}/dlq", f"{root}/cp")


def test_tables_of_an_older_contract_are_refused(spark, root, monkeypatch):
    store = DocumentStore(spark, f"{root}/docs")
    monkeypatch.setattr(C, "CONTRACT_VERSION", 1)
    store.upsert(_doc(spark, 5))
    monkeypatch.undo()
    assert store.contract_version() == 1
    with pytest.raises(gates.GateError):
        indexing.start(None, store, f"{root}/dlq", f"{root}/cp")


def test_index_and_file_streams(spark, root):
    h = "https://h/"
    items = [
        message(message_id="1", raw_payload=f'{{"type":8,"url":"{h}1","name":"a.txt"}}'),
        message(message_id="2", raw_payload=f'{{"type":8,"url":"{h}2","name":"a.zip"}}'),
        message(message_id="3", raw_payload='{"type":1,"content":"t"}'),
        message(message_id="x", raw_payload='{"type":1,"content":"t"}'),
        message(message_id="4", raw_payload='{"type":1,"content":"t","visibles":[]}'),
    ]
    records = wire.encode(messages(spark, *items), "t").withColumn("partition", F.lit(0)).withColumn("offset", F.monotonically_increasing_id())
    records.select("topic", "partition", "offset", "key", "value").write.parquet(f"{root}/in")
    store = DocumentStore(spark, f"{root}/docs")
    indexing.start(streams.file_stream(spark, f"{root}/in"), store, f"{root}/dlq", f"{root}/cp").awaitTermination()
    assert sorted(r["_id"] for r in store.read().collect()) == ["1", "2", "3"]
    dead = spark.read.parquet(f"{root}/dlq").collect()
    assert {(r["key"].decode(), r["reason"], r["status"]) for r in dead} == {("x", C.INDEXER_PERMANENT, 400), ("4", C.INDEXER_UNTRUSTED, 0)}
    # the same batch again changes nothing
    indexing.index_batch(spark.read.parquet(f"{root}/in"), "0" * 12, store, f"{root}/dlq")
    assert store.read().count() == 3 and spark.read.parquet(f"{root}/dlq").count() == 2
    bodies = spark.createDataFrame([(h + "1", bytearray(b"text one"))], "url string, body binary")
    leg = extraction.FileLeg(store, bodies, ["h"], f"{root}/files")
    extraction.start(streams.file_stream(spark, f"{root}/in"), leg, f"{root}/cp2", lambda: 50).awaitTermination()
    d = {r["_id"]: r["payload"]["file"] for r in store.read().collect()}
    assert d["1"]["content"] == "text one" and d["2"]["contentMeta"]["reason"] == "blacklist_ext" and d["3"] is None
    assert files.pending_files(store.read()).count() == 0
    # a redelivery of the message keeps the text
    indexing.index_batch(spark.read.parquet(f"{root}/in"), "1" * 12, store, f"{root}/dlq")
    assert {r["_id"]: r["payload"]["file"] for r in store.read().collect()}["1"]["content"] == "text one"


def test_a_newer_delivery_replaces_a_waiting_one(spark, root):
    store = DocumentStore(spark, f"{root}/docs")
    bodies = spark.createDataFrame([("https://h/old.txt", bytearray(b"old text")), ("https://h/new.txt", bytearray(b"new text"))], "url string, body binary")
    leg = extraction.FileLeg(store, bodies, ["h"], root)
    sent = lambda url: messages(spark, message(message_id="1", raw_payload=f'{{"type":8,"url":"https://h/{url}.txt","name":"a.txt"}}'))
    place = lambda url, offset: wire.encode(sent(url), "t").withColumn("partition", F.lit(0)).withColumn("offset", F.lit(offset).cast("bigint"))
    waiting = lambda: [(r["url"][10:13], r["offset"], r["attempts"]) for r in leg.waiting().collect()]
    leg.run(place("old", 5), "a", 100)
    assert waiting() == [("old", 5, 1)]
    leg.run(place("new", 6), "b", 500)  # the old one is due, the new one counts
    assert waiting() == [("new", 6, 1)]
    leg.run(place("old", 5), "c", 500)  # an older place comes again: the new one keeps waiting
    assert waiting() == [("new", 6, 1)]
    store.upsert(documents.from_contract(sent("new")))
    leg.retry_due(9000)
    assert waiting() == [] and store.read().first()["payload"]["file"]["content"] == "new text"


def test_text_of_a_late_document_is_retried(spark, root):
    h = "https://h/"
    m = messages(spark, message(message_id="1", raw_payload=f'{{"type":8,"url":"{h}1","name":"a.txt"}}'))
    records = wire.encode(m, "t").selectExpr("topic", "0 AS partition", "0L AS offset", "key", "value")
    store = DocumentStore(spark, f"{root}/docs")
    bodies = spark.createDataFrame([(h + "1", bytearray(b"text one"))], "url string, body binary")
    empty = records.where("false")

    leg = extraction.FileLeg(store, bodies, ["h"], root, max_attempts=3)

    def step(batch, name, now):
        leg.run(batch, name, now)
        return [(r["attempts"], r["next_attempt_at"]) for r in leg.waiting().collect()]

    assert step(records, "a", 100) == [(1, 101)]
    assert step(records, "a", 900) == [(1, 101)]  # the same batch again: the same clock, the same retries
    assert step(empty, "b", 100) == [(1, 101)]  # not due yet
    leg.retry_due(100)
    assert leg.state.read()[1]["batch"] == "b"  # nothing to do
    leg.retry_due(101)  # no new input, and a leg that starts anew finds the state
    leg = extraction.FileLeg(store, bodies, ["h"], root, max_attempts=3)
    assert [(r["attempts"], r["next_attempt_at"]) for r in leg.waiting().collect()] == [(2, 103)]
    store.upsert(documents.from_contract(m))
    leg.retry_due(103)
    assert leg.waiting().count() == 0
    assert store.read().first()["payload"]["file"]["content"] == "text one"
    gone = wire.encode(messages(spark, message(message_id="9", raw_payload=f'{{"type":8,"url":"{h}1","name":"a.txt"}}')), "t")
    gone = gone.selectExpr("topic", "0 AS partition", "1L AS offset", "key", "value")
    step(gone, "c", 200)
    step(empty, "d", 300)
    assert step(empty, "e", 400) == []
    last = {r["messageId"]: r for r in leg.letters().collect()}["9"]
    assert (last["reason"], last["offset"], last["fileURL"], last["spilledAt"]) == (C.FILE_RETRY, 1, f"{h}1", 400) and b"a.txt" in bytes(last["value"])


def test_last_delivery_and_old_versions_in_the_file_leg(spark, root):
    old = message(message_id="1", schema_version=1, raw_payload='{"type":8,"url":"https://h/1","name":"a.txt"}')
    new = message(message_id="1", raw_payload='{"type":8,"url":"https://h/2","name":"a.txt"}')
    records = wire.encode(messages(spark, new, old), "t").withColumn("partition", F.lit(0))
    records = records.withColumn("offset", F.when(F.contains("value", F.lit(b"h/2")), 5).otherwise(9).cast("bigint")).select("topic", "partition", "offset", "key", "value")
    found, bad = extraction.batch_files(records)
    assert [(r["url"], r["offset"]) for r in found.collect()] == [("https://h/1", 9)] and bad.count() == 0
    assert tables.staged(wire.judged(records), "judged").where("reason IS NOT NULL").count() == 1


def test_formats_without_an_extractor_stay_pending(spark, root):
    h = "https://h/"
    m = messages(spark, *[message(message_id=str(i), raw_payload=f'{{"type":8,"url":"{h}1","name":"{n}"}}') for i, n in enumerate(["a.pdf", "a.docx", "none"])])
    records = wire.encode(m, "t").withColumn("offset", F.monotonically_increasing_id()).selectExpr("topic", "0 AS partition", "offset", "key", "value")
    store = DocumentStore(spark, f"{root}/docs")
    store.upsert(documents.from_contract(m))
    bodies = spark.createDataFrame([(h + "1", bytearray(b"body"))], "url string, body binary")
    extraction.FileLeg(store, bodies, ["h"], f"{root}/files").run(records, "a", 1)
    out = file_backfill.run(store, bodies, ["h"], 1, f"{root}/dlq", "1")
    assert {r["outcome"] for r in out.collect()} == {files.NO_EXTRACTOR}
    assert files.pending_files(store.read()).count() == 3 and file_backfill.letters(spark, f"{root}/dlq").count() == 0
    assert files.backfill_gate(out).first()["verdict"] == "open_items"

    def plugin(batches):
        for b in batches:
            yield pd.DataFrame({"content": [f"text{e}" for e in b["ext"]], "error_kind": None, "extract_ms": 2})

    extraction.FileLeg(store, bodies, ["h"], f"{root}/more", extractor=plugin).run(records, "a", 1)
    assert sorted(r["payload"]["file"]["content"] for r in store.read().collect()) == ["text", "text.docx", "text.pdf"]


def test_letters_of_a_repeated_backfill_stay(spark, root):
    store = DocumentStore(spark, f"{root}/docs")
    store.upsert(documents.from_contract(messages(spark, message(message_id="2", raw_payload='{"type":8,"url":"ftp://h/2","name":"a.txt"}'))))
    bodies = spark.createDataFrame([], "url string, body binary")
    for now in (5, 6):
        file_backfill.run(store, bodies, ["h"], now, f"{root}/dlq", "1")
    assert [(r["message_id"], r["reason"], r["spilled_at"]) for r in file_backfill.letters(spark, f"{root}/dlq").collect()] == [("2", "invalid_url", 5)]


def test_cut_text_must_not_be_blank(spark):
    wanted = spark.createDataFrame([("1", "https://h/1", "a.txt", "\u2003.TXT\t", None)], "message_id string, url string, name string, extension string, size bigint")
    bodies = spark.createDataFrame([("https://h/1", bytearray(b" " * 20 + b"text"))], "url string, body binary")
    got = files.extract_files(wanted, bodies, ["h"], max_content_bytes=10).first()
    assert (got["ext"], got["outcome"], got["content"]) == (".txt", "empty_extract", None)
    assert files.extract_files(wanted, bodies, ["h"], max_content_bytes=22).first()["content"] == " " * 20 + "te"


def test_heads_stay_hidden(spark):
    page = "<html><head><script>if (a</script ><title>T</title><style>x</style></head><body>A<p>B</p><noscript>N</noscript></body></html>"
    assert spark.createDataFrame([(page,)], "h string").select(textx.html_text(F.col("h"))).first()[0] == "AB"


def test_payload_is_kept_to_the_letter(spark):
    raw = '{ "x":1.50,"y":1e2, "z":12345678901234567890123.10,"s":"a,\\"raw_payload\\":1","type":7}'
    records = wire.encode(messages(spark, message(raw_payload=raw)), "t").selectExpr("topic", "0 AS partition", "0L AS offset", "key", "value")
    assert wire.decode(records).first()["raw_payload"] == raw
    assert tables.staged(wire.judged(records), "judged").select(F.inline("docs")).first()["payloadRaw"] == raw
    other = records.withColumn("value", F.expr("""encode(concat(substr(decode(value, 'UTF-8'), 1, length(decode(value, 'UTF-8')) - 1), ',"more":1}'), 'UTF-8')"""))
    assert wire.decode(other).first()["raw_payload"] is not None


def test_large_documents_are_refused_in_both_legs(spark):
    text = "x" * 3000
    raw = json.dumps({"type": 1, "content": text})
    r = rows(spark, row("1", raw, id=1), row("2", '{"type":1,"content":"x"}', id=2))
    got = {x["message_id"]: x["reason"] for x in tables.staged(historical.judged_rows(r, max_doc_bytes=3000), "judged").collect()}
    assert got == {"1": C.LOAD_REJECT, "2": None}
    records = wire.encode(messages(spark, message(message_id="1", raw_payload=raw, content=text)), "t").selectExpr("topic", "0 AS partition", "0L AS offset", "key", "value")
    assert [tables.staged(wire.judged(records, n), "judged").first()["status"] for n in (3000, 100_000_000)] == [413, None]


def test_a_tick_reads_its_source_once(spark, root):
    """A source that grows between reads: a row committed late must not slip in below the cursor."""
    first = [row("1", id=1), row("3", id=3)]
    later = [row("2", id=2, created_unix=1700009999)]
    names = [n for n, _ in C.ROW_FIELDS]

    def live(batches):
        list(batches)
        with open(f"{root}/reads", "a+") as log:
            log.seek(0)
            seen = len(log.read())
            log.write("x")
        yield pd.DataFrame([[i[n] for n in names] for i in (first if not seen else first + later)], columns=names)

    source = spark.range(1, numPartitions=1).mapInPandas(live, C.ddl(C.ROW_FIELDS))
    p = VersionedPointer(spark, f"{root}/cursors")
    assert incremental.run_tick(source, p, root, 1700010000, 600) == {"message": 3}
    assert {x["key"].decode() for x in incremental.main_records(spark, root, p).collect()} == {"1", "3"}
    with open(f"{root}/reads") as log:
        assert log.read() == "x"


def test_a_load_that_lost_the_race_says_so(spark, root, monkeypatch):
    target = historical.LoadTarget.below(spark, root)
    commit = VersionedPointer.commit
    monkeypatch.setattr(VersionedPointer, "commit", lambda self, e, v: False if self._root.getName() == "cursors" else commit(self, e, v))
    with pytest.raises(ConcurrentWrite):
        historical.run(rows(spark, row(id=1)), target)


def test_the_sample_moves_no_payload(spark):
    r = rows(spark, *[row(str(i), id=i) for i in range(20)])
    excluded = spark.createDataFrame([("3",)], "message_id string")
    got = recon.comparable_sample(r, excluded, 0, 2**40, 5)
    assert sorted(x["id"] for x in got.collect()) == [0, 1, 10, 11, 12]
    plan = recon.compare(recon.expected_fields(got), _doc(spark, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_file_backfill_job(spark, root):
    h = "https://h/"
    store = DocumentStore(spark, f"{root}/docs")
    m = messages(
        spark,
        message(message_id="1", raw_payload=f'{{"type":8,"url":"{h}1","name":"a.txt"}}'),
        message(message_id="2", raw_payload='{"type":8,"url":"ftp://h/2","name":"a.txt"}'),
        message(message_id="3", raw_payload=f'{{"type":8,"url":"{h}3","name":"a.txt"}}'),
    )
    store.upsert(documents.from_contract(m))
    bodies = spark.createDataFrame([(h + "1", bytearray(b"text"))], "url string, body binary")
    out = file_backfill.run(store, bodies, ["h"], 7, f"{root}/dlq", "1")
    assert {r["message_id"]: r["outcome"] for r in out.collect()} == {"1": "ok", "2": "invalid_url", "3": "download_failed"}
    # only what may still work is left for the next run
    assert [r["message_id"] for r in files.pending_files(store.read()).collect()] == ["3"]


# ---- gates ---------------------------------------------------------------------------------------
def test_gates(spark):
    docs = spark.createDataFrame([], C.ddl(C.DOC_FIELDS))
    gates.require_compatible(docs.schema)
    gates.require_reader_fields(docs.schema)
    gates.require_shard_names(C.SHARDS)
    for check in (
        lambda: gates.require_compatible(docs.drop("virtual").schema), lambda: gates.require_reader_fields(docs.drop("visibles").schema),
        lambda: gates.require_window(2, 1), lambda: gates.require_lag(0), lambda: gates.require_contract(1), lambda: gates.require_shard_names(["a;b"]),
    ):
        with pytest.raises(gates.GateError):
            check()


def test_every_query_has_a_twin_or_is_known_not_to():
    from checks.queries import QUERIES, SQL

    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"doc_oversize"}
