import pytest

from searchloom import contract as C
from searchloom.operators import documents, upsert
from tests.helpers import docs, message, messages


def test_text_and_omitted_values(spark):
    d = docs(spark, ['{"type":1,"content":"hi"}', '{"type":1,"content":""}', '{"type":1}'])
    assert d["1"]["payload"]["text"]["content"] == "hi"
    # the sub-object is there even without content, so the document is searchable by type
    for i in ("2", "3"):
        assert d[i]["payload"]["text"] is not None and d[i]["payload"]["text"]["content"] is None
        assert d[i]["rawExcluded"] is None
    assert d["1"]["subSeq"] == 0 and d["1"]["virtual"] is None and d["1"]["to"] is None


def test_image_sizes_are_clamped(spark):
    d = docs(
        spark,
        ['{"type":2,"url":"u","name":"n","caption":"c","width":800,"height":600}', '{"type":2,"width":2147483648,"height":-1}', '{"type":2,"width":2147483647,"height":"9"}'],
    )
    image = d["1"]["payload"]["image"]
    assert (image["url"], image["name"], image["caption"], image["width"], image["height"]) == ("u", "n", "c", 800, 600)
    assert (d["2"]["payload"]["image"]["width"], d["2"]["payload"]["image"]["height"]) == (None, None)
    assert (d["3"]["payload"]["image"]["width"], d["3"]["payload"]["image"]["height"]) == (2147483647, None)


@pytest.mark.parametrize(
    ("name", "ext", "video"),
    [
        ("clip.mp4", "", True), ("clip.MP4", "pdf", True), ("clip.pdf", "mp4", False), (".mkv", "mkv", True), (".mkv", "", False),
        ("clip.", "ts", True), ("a.b.webm", "", True), ("", "MOV", True), ("noext", "", False),
    ],
)
def test_videos_sent_as_files(spark, name, ext, video):
    d = docs(spark, [f'{{"type":8,"url":"u","name":"{name}","extension":"{ext}","size":5}}'])["1"]
    assert d["payload"]["type"] == (5 if video else 8)
    if video:
        assert d["payload"]["video"]["url"] == "u" and d["payload"]["file"] is None
        assert '"type":8' in d["payloadRaw"]


def test_file_sizes(spark):
    d = docs(spark, ['{"type":8,"size":"123"}', '{"type":8,"size":9007199254740993}', '{"type":8,"size":1.0}', '{"type":8,"size":" 5"}'])
    assert [d[str(i)]["payload"]["file"]["size"] for i in range(1, 5)] == [123, 9007199254740993, None, None]


def test_merged_messages_keep_full_ids(spark):
    d = docs(
        spark,
        [
            '{"type":11,"msgs":[{"message_id":"9007199254740993","from_uid":"f","timestamp":1700000123,"payload":{"type":1,"content":"in"}},'
            '{"message_id":9007199254740994,"payload":{"type":8,"name":"n","caption":"c"}},{"payload":{"type":2,"caption":"c","name":"n"}},'
            '{"payload":{"type":14,"content":[{"type":"image"},{"type":"file","name":"z"}]}},{"payload":{"type":3,"url":"q"}},"x",7]}',
            '{"type":11,"msgs":[]}',
            '{"type":11,"msgs":[1,"a"]}',
            '{"type":11}',
        ],
    )
    m = d["1"]["payload"]["mergeForward"]
    assert m["childCount"] == 5
    assert [x["messageId"] for x in m["msgs"]][:2] == [9007199254740993, 9007199254740994]
    assert [x["searchText"] for x in m["msgs"]] == ["in", "n c", "c n", "[图片][文件] z z", None]
    assert (m["msgs"][0]["from"], m["msgs"][0]["timestamp"]) == ("f", 1700000123)
    for i in ("2", "3", "4"):
        assert d[i]["payload"]["mergeForward"] is None and d[i]["rawExcluded"] is True


def test_rich_text_and_its_images(spark):
    blocks = (
        '[{"type":"text","text":"a "},{"type":"image","name":"v1","url":"u1","width":640,"height":480},'
        '{"type":"file","name":"f","url":"uf"},7,{"type":"image","url":""},{"type":"image","url":"u2","caption":"cc"}]'
    )
    d = docs(spark, [f'{{"type":14,"space_id":"s","visibles":["v"],"content":{blocks}}}'])
    assert sorted(d) == ["1", "1-rt1", "1-rt4"]
    assert d["1"]["payload"]["richText"]["searchText"] == "a [图片][文件] f[图片][图片] v1 f cc"
    child = d["1-rt4"]
    assert (child["subSeq"], child["parentMessageId"], child["parentPayloadType"], child["virtual"]) == (5, 1, 14, True)
    assert child["payload"]["type"] == 2 and child["payload"]["image"]["url"] == "u2"
    assert child["payload"]["image"]["caption"] is None and child["payloadRaw"] is None
    assert (child["messageSeq"], child["spaceId"], child["visibles"]) == (7, "s", ["v"])
    assert d["1-rt1"]["payload"]["image"]["width"] == 640


@pytest.mark.parametrize(
    ("payload", "text"),
    [
        ('{"type":14,"content":"whole"}', "whole"),
        ('{"type":14,"content":""}', None),
        ('{"type":14,"plain":" given ","content":[{"type":"text","text":"t"}]}', " given "),
        ('{"type":14,"plain":" \\u3000 ","content":[{"type":"text","text":"t"}]}', "t"),
        ('{"type":14,"content":[{"type":5,"text":"odd"},{"text":"none"}]}', "oddnone"),
        ('{"type":14,"content":{}}', None),
    ],
)
def test_rich_search_text(spark, payload, text):
    d = docs(spark, [payload])["1"]
    assert (d["payload"]["richText"]["searchText"] if d["payload"]["richText"] else None) == text
    assert d["rawExcluded"] == (None if text else True)


def test_unknown_types_keep_their_payload(spark):
    d = docs(spark, ['{"type":99,"note":"n"}', '{"note":"n"}', '{"type":1.5,"content":"x"}', '{"type":2.0}'])
    assert d["1"]["payload"]["type"] == 99
    assert all(d[str(i)]["payload"] is None for i in (2, 3, 4))
    assert all(r["rawExcluded"] and r["payloadRaw"] for r in d.values())


def test_branches_of_a_message(spark):
    out = documents.from_contract(
        messages(
            spark,
            message(message_id="1", raw_payload="{}"),
            message(message_id="2", raw_payload='["a","b"]'),
            message(message_id="3", raw_excluded=True, content="hidden", content_type=1),
            message(message_id="4", content="old", content_type=1, visibles=["v"], space_id="s"),
            message(message_id="5", content="old", content_type=2),
            message(message_id="6", content="", content_type=1),
            message(message_id="not-a-number"),
            message(message_id=" 7 "),
            message(message_id="99999999999999999999"),
            message(message_id="007", raw_payload='{"type":1,"content":"z"}', raw_excluded=True),
        )
    )
    d = {r["_id"]: r for r in out.collect()}
    assert sorted(d) == ["1", "2", "3", "4", "5", "6", "7"]
    assert d["1"]["payload"] is None and d["1"]["payloadRaw"] == "{}" and d["1"]["rawExcluded"]
    assert d["2"]["payload"] is None and d["2"]["payloadRaw"] is None
    assert d["3"]["payload"] is None and d["3"]["rawExcluded"]
    assert d["4"]["payload"]["text"]["content"] == "old" and d["4"]["visibles"] == ["v"] and d["4"]["spaceId"] == "s"
    assert d["5"]["payload"]["type"] == 2 and d["5"]["payload"]["text"] is None and d["5"]["rawExcluded"] is None
    assert d["6"]["payload"]["text"] is None
    assert d["7"]["payload"]["text"]["content"] == "z" and d["7"]["rawExcluded"] is None


@pytest.mark.parametrize(
    ("channel", "sender", "peer"),
    [("a@b", "a", "b"), ("a@b", "b", "a"), ("a@b", "z", "a"), ("ab", "a", None), ("a@b@c", "a", None), ("a@", "a", None)],
)
def test_reverse_peer(spark, channel, sender, peer):
    m = messages(spark, message(channel_type=1, channel_id=channel, from_uid=sender, raw_payload='{"type":4}'))
    assert documents.from_contract(m).first()["to"] == peer


def test_legacy_documents(spark):
    ddl = "message_id string, channel_id string, channel_type int, from_uid string, msg_timestamp bigint, created_at bigint, raw_excluded boolean, schema_version int, content string, content_type int"
    flat = spark.createDataFrame([("12", "c", 1, "f", 5, 6, True, 1, "t", 2), ("x1", "c", 1, "f", 5, 6, True, 1, "t", 2)], ddl)
    d = documents.migrate_legacy(flat.where("message_id = '12'")).first()
    # the text is attached whatever the type
    assert (d["messageId"], d["payload"]["type"], d["payload"]["text"]["content"], d["subSeq"], d["visibles"]) == (12, 2, "t", 0, None)
    with pytest.raises(Exception, match="no number"):
        documents.migrate_legacy(flat).collect()


# ---- keyed writes -------------------------------------------------------------------
def frame(spark, items):
    """Documents from (id, payload dict of file fields or None, text or None)."""
    names = C.DOC_COLUMNS
    out = []
    for _id, file, text in items:
        meta = None if file is None or "meta" not in file else {"extractedAt": 1, "extractor": "e", "truncated": True, "extractMs": None, "status": file["meta"], "reason": None}
        payload = {
            "type": 8 if file is not None else 1,
            "text": {"content": text} if text else None,
            "file": None if file is None else {"url": file.get("url"), "content": file.get("content"), "contentMeta": meta},
        }
        out.append(tuple({"_id": _id, "messageId": int(_id), "payload": payload}.get(n) for n in names))
    return spark.createDataFrame(out, C.ddl(C.DOC_FIELDS))


def test_upsert_keeps_extracted_text(spark):
    old = frame(
        spark,
        [("1", {"content": "t1", "meta": "m1"}, None), ("2", {"content": "t2"}, None), ("3", {"meta": "m3"}, None), ("4", {"url": "old"}, None), ("5", {"content": "t5"}, None), ("6", None, "only old")],
    )
    new = frame(spark, [("1", {"url": "n"}, None), ("2", {"url": "n"}, None), ("3", {"url": "n"}, None), ("4", {"url": "n"}, None), ("5", None, "now text"), ("7", None, "only new")])
    d = {r["_id"]: r for r in upsert.upsert(old, new).collect()}
    assert sorted(d) == list("1234567")
    f = {i: d[i]["payload"]["file"] for i in "12345"}
    assert (f["1"]["content"], f["1"]["contentMeta"]["status"], f["1"]["url"]) == ("t1", "m1", "n")
    assert f["2"]["content"] == "t2" and f["2"]["contentMeta"] is None
    assert f["3"]["content"] is None and f["3"]["contentMeta"]["status"] == "m3"
    assert f["4"]["content"] is None and f["4"]["url"] == "n"
    # even when the new document is no file
    assert f["5"]["content"] == "t5" and d["5"]["payload"]["text"]["content"] == "now text" and d["5"]["payload"]["type"] == 1
    assert d["6"]["payload"]["text"]["content"] == "only old" and d["7"]["payload"]["text"]["content"] == "only new"


def test_partial_update_merges_field_by_field(spark):
    docs_ = frame(spark, [("1", {"url": "u", "content": "old", "meta": "unextractable"}, None), ("2", None, "t"), ("3", {"url": "u"}, None)])
    good = spark.createDataFrame([("1", "new", False, 9, "x", 4), ("2", "c", True, 9, "x", 4), ("9", "c", True, 9, "x", 4)], "_id string, content string, truncated boolean, extracted_at bigint, extractor string, extract_ms bigint")
    updates = upsert.content_updates(good)
    d = {r["_id"]: r for r in upsert.partial_update(docs_, updates).collect()}
    f = d["1"]["payload"]["file"]
    # the mark of an earlier failure stays: a success does not write that field
    assert (f["content"], f["contentMeta"]["status"], f["contentMeta"]["truncated"], f["url"]) == ("new", "unextractable", False, "u")
    assert d["2"]["payload"]["file"]["content"] == "c" and d["2"]["payload"]["text"]["content"] == "t"
    assert d["3"]["payload"]["file"]["contentMeta"] is None
    assert "9" not in d
    assert [r["_id"] for r in upsert.unmatched_updates(docs_, updates).collect()] == ["9"]


def test_tombstones_only_for_lasting_reasons(spark):
    every = [*C.TOMBSTONE_REASONS, "download_failed", "extract_timeout", "parse_error", "retry_exhausted", "os_permanent", "", "other"]
    df = spark.createDataFrame([(str(i), r, 3) for i, r in enumerate(every)], "_id string, reason string, extracted_at bigint")
    out = {r["contentMeta"]["reason"] for r in upsert.tombstones(df).collect()}
    assert out == {"blacklist_ext", "oversize", "encrypted", "empty_extract", "extract_error", "invalid_url"}
