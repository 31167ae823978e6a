"""Contract messages to search documents: typed projection and derived image documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import jsonx, textx
from searchloom.operators.enrich import BODY_FIELDS
from searchloom.session import built_once

SUB_OBJECTS = ["text", "image", "gif", "voice", "video", "file", "mergeForward", "richText"]


BLOCK_FIELDS = ["type", "text", "name", "caption", "url", "width", "height"]
ITEM_FIELDS = ["message_id", "from_uid", "timestamp", "payload"]
INNER_FIELDS = ["type", "content", "caption", "name", "plain"]


def typed_fields(body: Column) -> Column:
    """Typed values of the payload fields; a value of the wrong type is null."""
    strings = ["content", "url", "caption", "name", "cover", "extension", "plain"]
    sizes = ["width", "height", "second"]
    return F.struct(
        jsonx.integer_of(body["type"]).alias("type"),
        *[jsonx.string_of(body[n]).alias(n) for n in strings],
        *[jsonx.integer_of(body[n]).alias(n) for n in sizes],
        jsonx.integer_or_text_of(body["size"]).alias("size"),
    )


# ---- typed sub-objects of a payload (f: struct of typed_fields) --------------
def _text(f: Column, name: str) -> Column:
    return jsonx.empty_as_null(f[name]).alias(name)


def _size(f: Column, name: str) -> Column:
    return jsonx.clamp_int32(f[name]).alias(name)


def text_part(f: Column) -> Column:
    return F.struct(_text(f, "content"))


def image_part(f: Column) -> Column:
    return F.struct(
        _text(f, "url"), _text(f, "caption"), _text(f, "name"), _size(f, "width"), _size(f, "height")
    )


def url_part(f: Column) -> Column:
    return F.struct(_text(f, "url"))


def video_part(f: Column) -> Column:
    return F.struct(
        _text(f, "url"), _text(f, "cover"), _size(f, "width"), _size(f, "height"), _size(f, "second")
    )


def file_as_video_part(f: Column) -> Column:
    nothing = F.lit(None)
    return F.struct(
        _text(f, "url"),
        nothing.cast("string").alias("cover"),
        nothing.cast("int").alias("width"),
        nothing.cast("int").alias("height"),
        nothing.cast("int").alias("second"),
    )


def file_part(f: Column) -> Column:
    return F.struct(
        _text(f, "url"),
        _text(f, "name"),
        _text(f, "caption"),
        jsonx.zero_as_null(f["size"]).alias("size"),
        _text(f, "extension"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast(C.META_DDL).alias("contentMeta"),
    )


def is_video_file(f: Column) -> Column:
    """A file whose extension (name first) is one of the video formats."""
    return textx.extension_name_first(f["extension"], f["name"]).isin(C.VIDEO_EXTENSIONS)


def _objects(array: Column, names: list[str]) -> Column:
    """Fields of the object elements of an array, in order; other elements are left out."""
    return F.filter(F.transform(array, lambda x: jsonx.fields_of(x, names)), lambda s: s.isNotNull())


def rich_blocks(content: Column) -> Column:
    """Object blocks of a rich text in order; a string content is one text block."""
    typed = F.transform(
        _objects(jsonx.array_of(content), BLOCK_FIELDS),
        lambda b: F.struct(
            *[jsonx.string_of(b[n]).alias(n) for n in BLOCK_FIELDS[:5]],
            *[jsonx.integer_of(b[n]).alias(n) for n in BLOCK_FIELDS[5:]],
        ),
    )
    given = F.transform(
        typed,
        lambda b: F.struct(
            b["type"].alias("type"),
            *[_text(b, n) for n in BLOCK_FIELDS[1:5]],
            *[_size(b, n) for n in BLOCK_FIELDS[5:]],
        ),
    )
    nothing = F.lit(None)
    single = F.transform(
        F.array(jsonx.string_of(content)),
        lambda t: F.struct(
            F.lit("text").alias("type"),
            t.alias("text"),
            *[nothing.cast("string").alias(n) for n in BLOCK_FIELDS[2:5]],
            *[nothing.cast("int").alias(n) for n in BLOCK_FIELDS[5:]],
        ),
    )
    return F.coalesce(given, F.filter(single, lambda b: b["text"] != ""))


def rich_plain(blocks: Column) -> Column:
    """Blocks as plain text: marks stand for images and files."""
    return F.array_join(
        F.transform(
            blocks,
            lambda b: F.when(b["type"] == "image", F.lit(C.IMAGE_MARK))
            .when(b["type"] == "file", F.concat_ws(" ", F.lit(C.FILE_MARK), b["name"]))
            .otherwise(F.coalesce(b["text"], F.lit(""))),
        ),
        "",
    )


def rich_search_text(plain: Column, blocks: Column) -> Column:
    """Plain text (the given one unless blank) and the names and captions of media blocks.

    May be empty; callers turn that into null.
    """
    text = F.when(plain.isNotNull() & ~textx.is_blank(plain), plain).otherwise(rich_plain(blocks))
    labels = F.flatten(
        F.transform(
            F.filter(blocks, lambda b: b["type"].isin("image", "file")),
            lambda b: F.array(b["name"], b["caption"]),
        )
    )
    parts = F.concat(F.array(text), F.coalesce(labels, F.array().cast("array<string>")))
    return F.array_join(F.filter(parts, lambda p: p != ""), " ")


def merge_items(msgs: Column) -> Column:
    """Forwarded messages: object items only, each with its own searchable text.

    Works in steps, because a value used twice inside one lambda is computed twice.
    """
    opened = F.transform(
        _objects(jsonx.array_of(msgs), ITEM_FIELDS),
        lambda m: F.struct(
            jsonx.integer_or_text_of(m["message_id"]).alias("id"),
            jsonx.string_of(m["from_uid"]).alias("from"),
            jsonx.integer_or_text_of(m["timestamp"]).alias("at"),
            jsonx.fields_of(m["payload"], INNER_FIELDS).alias("inner"),
        ),
    )
    typed = F.transform(
        opened,
        lambda m: F.struct(
            m["id"].alias("id"),
            m["from"].alias("from"),
            m["at"].alias("at"),
            jsonx.integer_of(m["inner"]["type"]).alias("type"),
            m["inner"]["content"].alias("content"),
            *[jsonx.string_of(m["inner"][n]).alias(n) for n in INNER_FIELDS[2:]],
        ),
    )
    texts = F.transform(
        typed,
        lambda m: F.struct(
            m["id"].alias("id"),
            m["from"].alias("from"),
            m["at"].alias("at"),
            m["type"].alias("type"),
            search_text(m).alias("text"),
        ),
    )
    return F.transform(
        texts,
        lambda m: F.struct(
            jsonx.zero_as_null(m["id"]).alias("messageId"),
            jsonx.zero_as_null(m["type"]).alias("type"),
            jsonx.empty_as_null(m["text"]).alias("searchText"),
            jsonx.empty_as_null(m["from"]).alias("from"),
            jsonx.zero_as_null(m["at"]).alias("timestamp"),
        ),
    )


def search_text(m: Column) -> Column:
    """Searchable text of a message inside a bundle, by its type; may be empty."""
    kind = m["type"]

    def joined(*names: str) -> Column:
        return F.array_join(F.filter(F.array(*[m[n] for n in names]), lambda p: p != ""), " ")

    return (
        F.when(kind == C.TYPE_TEXT, jsonx.string_of(m["content"]))
        .when(kind == C.TYPE_IMAGE, joined("caption", "name"))
        .when(kind == C.TYPE_FILE, joined("name", "caption"))
        .when(kind == C.TYPE_RICH, rich_search_text(m["plain"], rich_blocks(m["content"])))
    )


def payload_struct(f: Column, video: Column, items: Column, rich: Column) -> Column:
    """All typed sub-objects; exactly the one of the type is set. Null without a type."""
    kind = f["type"]
    parts = F.struct(
        F.when(video, F.lit(C.TYPE_VIDEO)).otherwise(kind).cast("bigint").alias("type"),
        F.when(kind == C.TYPE_TEXT, text_part(f)).alias("text"),
        F.when(kind == C.TYPE_IMAGE, image_part(f)).alias("image"),
        F.when(kind == C.TYPE_GIF, url_part(f)).alias("gif"),
        F.when(kind == C.TYPE_VOICE, url_part(f)).alias("voice"),
        F.when(kind == C.TYPE_VIDEO, video_part(f)).when(video, file_as_video_part(f)).alias("video"),
        F.when((kind == C.TYPE_FILE) & ~video, file_part(f)).alias("file"),
        F.when(F.size(items) > 0, F.struct(F.size(items).alias("childCount"), items.alias("msgs"))).alias(
            "mergeForward"
        ),
        F.when(rich != "", F.struct(rich.alias("searchText"))).alias("richText"),
    )
    return F.when(kind.isNotNull(), parts)


def legacy_payload(kind: Column, content: Column) -> Column:
    """Payload of a message that carries no raw payload: type, and text for type 1."""
    text = F.when((kind == C.TYPE_TEXT) & (content != ""), F.struct(content.alias("content")))
    nothing = [F.lit(None).alias(n) for n in SUB_OBJECTS[1:]]
    return F.struct(kind.alias("type"), text.alias("text"), *nothing).cast(C.PAYLOAD_DDL)


def is_projected(payload: Column) -> Column:
    """At least one typed sub-object is set."""
    found = payload[SUB_OBJECTS[0]].isNotNull()
    for name in SUB_OBJECTS[1:]:
        found = found | payload[name].isNotNull()
    return F.coalesce(found, F.lit(False))


def reverse_peer(channel_id: Column, from_uid: Column) -> Column:
    """The other side of a two-person channel id ``a@b``; null when it is no such id."""
    sides = F.split(channel_id, "@")
    peer = F.when(from_uid == sides[0], sides[1]).otherwise(sides[0])
    return F.when(F.size(sides) == 2, jsonx.empty_as_null(peer))


# ---- messages to documents ---------------------------------------------------
def with_projection(messages: DataFrame) -> DataFrame:
    """Add the projected columns of each message.

    ``messages`` has the contract columns and ``body``, the fields of raw_payload when
    that is a JSON object. Adds doc_number, branch (a raw payload, b excluded, c legacy),
    doc_fields, doc_blocks, doc_payload, doc_excluded, doc_to.
    """
    for name, column in _projection_steps():
        messages = messages.withColumn(name, column)
    return messages.drop("_video", "_items", "_rich")


@built_once
def _projection_steps() -> list[tuple[str, Column]]:
    """Columns of the projection in order; each step is used several times by later ones."""
    raw = F.coalesce(F.octet_length("raw_payload"), F.lit(0)) > 0
    open_ = F.col("branch") == "a"
    fields = F.col("doc_fields")
    kind = F.col("doc_fields.type")
    video = F.coalesce((kind == C.TYPE_FILE) & is_video_file(fields), F.lit(False))
    branch = F.when(raw, F.lit("a")).when(F.col("raw_excluded"), F.lit("b")).otherwise(F.lit("c"))
    payload = F.when(
        open_, payload_struct(fields, F.col("_video"), F.col("_items"), F.col("_rich"))
    ).when(F.col("branch") == "c", legacy_payload(F.col("content_type"), F.col("content")))
    excluded = F.when(open_, ~is_projected(F.col("doc_payload"))).otherwise(F.col("branch") == "b")
    peer = F.when(
        open_ & (F.col("channel_type") == C.PERSON_CHANNEL),
        reverse_peer(F.col("channel_id"), F.col("from_uid")),
    )
    rich = rich_search_text(fields["plain"], F.col("doc_blocks"))
    return [
        ("doc_number", jsonx.integer_text(F.col("message_id"))),
        ("branch", branch),
        ("doc_fields", F.when(open_, typed_fields(F.col("body")))),
        ("_video", video),
        ("_items", F.when(kind == C.TYPE_MERGE, merge_items(F.col("body.msgs")))),
        ("doc_blocks", F.when(kind == C.TYPE_RICH, rich_blocks(F.col("body.content")))),
        ("_rich", F.when(kind == C.TYPE_RICH, rich)),
        ("doc_payload", payload),
        ("doc_excluded", excluded),
        ("doc_to", peer),
    ]


def _true_or_null(flag: Column) -> Column:
    return F.when(flag, F.lit(True))


def _doc(number: Column, child: Column | None) -> Column:
    """One document; ``child`` (index, image) makes it a derived one."""

    def own(parent: Column, derived: Column) -> Column:
        return parent if child is None else derived

    nothing = F.lit(None)
    image = None
    if child is not None:
        empty = [nothing.alias(n) for n in SUB_OBJECTS if n not in ("text", "image")]
        image = F.struct(
            F.lit(C.TYPE_IMAGE).alias("type"),
            nothing.alias("text"),
            F.struct(
                child["url"].alias("url"),
                nothing.alias("caption"),
                child["name"].alias("name"),
                child["width"].alias("width"),
                child["height"].alias("height"),
            ).alias("image"),
            *empty,
        ).cast(C.PAYLOAD_DDL)
    fields = {
        "_id": own(number.cast("string"), F.concat(number.cast("string"), F.lit("-rt"), child["i"].cast("string")) if child is not None else None),
        "schemaVersion": F.col("schema_version"),
        "messageId": number,
        "messageSeq": jsonx.zero_as_null(F.col("message_seq")),
        "from": jsonx.empty_as_null(F.col("from_uid")),
        "to": F.col("doc_to"),
        "channelId": F.col("channel_id"),
        "channelType": F.col("channel_type"),
        "spaceId": jsonx.empty_as_null(F.col("space_id")),
        "visibles": F.when(F.size("visibles") > 0, F.col("visibles")),
        "timestamp": F.col("msg_timestamp"),
        "createdAt": jsonx.zero_as_null(F.col("created_at")),
        "rawExcluded": own(_true_or_null(F.col("doc_excluded")), nothing),
        "source": jsonx.empty_as_null(F.col("source")),
        "payload": own(F.col("doc_payload"), image),
        "payloadRaw": own(F.when(F.col("body").isNotNull(), F.col("raw_payload")), nothing),
        "parentMessageId": own(nothing, jsonx.zero_as_null(number)),
        "parentPayloadType": own(nothing, F.lit(C.TYPE_RICH)),
        "virtual": own(nothing, F.lit(True)),
        "subSeq": own(F.lit(0), child["i"] + 1 if child is not None else None),
    }
    types = dict(C.DOC_FIELDS)
    return F.struct(*[col.cast(types[name]).alias(name) for name, col in fields.items()])


@built_once
def doc_array() -> Column:
    """The document of a projected message followed by its derived image documents.

    Null when message_id is no number. Block indexes count object blocks only, so the
    id of a derived document stays the same when other blocks are skipped.
    """
    number = F.col("doc_number")
    numbered = F.transform(
        F.col("doc_blocks"),
        lambda b, i: F.struct(
            i.alias("i"), b["type"].alias("type"), b["url"].alias("url"), b["name"].alias("name"),
            b["width"].alias("width"), b["height"].alias("height"),
        ),
    )
    images = F.filter(numbered, lambda b: (b["type"] == "image") & b["url"].isNotNull())
    children = F.transform(images, lambda b: _doc(number, b))
    parent = F.array(_doc(number, None))
    return F.when(
        number.isNotNull(),
        F.when(F.size(images) > 0, F.concat(parent, children)).otherwise(parent),
    )


def documents(messages: DataFrame) -> DataFrame:
    """Documents of contract messages that carry ``body``; one pass, no shuffle."""
    return with_projection(messages).select(F.inline(doc_array()))


def from_contract(messages: DataFrame) -> DataFrame:
    """Documents of plain contract messages (parses raw_payload)."""
    return documents(jsonx.with_json_object(messages, "raw_payload", "body", BODY_FIELDS, allow_empty=True))


def migrate_legacy(flat: DataFrame) -> DataFrame:
    """Flat documents of the older index to nested ones; an id that is no number fails the job."""
    kind = F.col("content_type").cast("bigint")
    nothing = [F.lit(None).alias(n) for n in SUB_OBJECTS[1:]]
    text = F.when(F.col("content").isNotNull(), F.struct(F.col("content").alias("content")))
    number = F.when(
        F.col("message_id").rlike(jsonx.INTEGER_TEXT), F.col("message_id").cast("bigint")
    ).otherwise(F.raise_error(F.concat(F.lit("message_id is no number: "), F.coalesce("message_id", F.lit("null")))))
    fields = {
        "_id": F.col("message_id"),
        "schemaVersion": F.col("schema_version"),
        "messageId": number,
        "from": F.col("from_uid"),
        "channelId": F.col("channel_id"),
        "channelType": F.col("channel_type"),
        "timestamp": F.col("msg_timestamp"),
        "createdAt": F.col("created_at"),
        "rawExcluded": F.col("raw_excluded"),
        "payload": F.struct(kind.alias("type"), text.alias("text"), *nothing),
        "subSeq": F.lit(0),
    }
    return flat.select(
        *[fields.get(name, F.lit(None)).cast(kind_).alias(name) for name, kind_ in C.DOC_FIELDS]
    )
