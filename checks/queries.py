"""Registered queries: one per operator, each over the whole given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as O
from searchloom import contract as C
from searchloom.functions import jsonx, netx, textx
from searchloom.operators import (
    deadletters,
    delivery,
    documents,
    enrich,
    files,
    gates,
    limits,
    metrics,
    recon,
    search,
    stability,
    upsert,
    wire,
)
from searchloom.plans import cutover, file_backfill, historical, incremental, reconcile
from searchloom.session import configure, new_work_dir
from searchloom.sinks import tables
from searchloom.sinks.docstore import DocumentStore
from searchloom.sinks.pointer import VersionedPointer
from searchloom.sinks.searchindex import SearchIndex
from searchloom.sources import driver_tables, shards, shardstream, streams
from searchloom.streaming import extraction, indexing, producing, retries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FROM, TO, MID, NOW = O.FROM_UNIX, O.TO_UNIX, O.MID_UNIX, O.NOW_UNIX
# ids of the sample adapter are dense, so id ranges are narrow here
SLOTS = {"slot_width": 10**16}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# ---- frames ----------------------------------------------------------------------
def rows_of(spark, sf):
    return driver_tables.shard_rows(spark, sf)


def routed_of(spark, sf):
    return enrich.with_route(rows_of(spark, sf))


def messages_of(spark, sf, keep=("body",)):
    return enrich.contract_rows(routed_of(spark, sf), list(keep))


def docs_of(spark, sf):
    return documents.documents(messages_of(spark, sf))


def letters_of(spark, sf):
    judged = historical.judged_rows(rows_of(spark, sf))
    keep = ["shard_table", "id", "message_id", "payload", "created_unix", "reason"]
    return deadletters.load_letters(enrich.only(judged, F.col("reason").isNotNull(), *keep))


def written_docs(spark, sf):
    """Documents as the store has them: parsed once, however often they are read."""
    return tables.staged(docs_of(spark, sf), "docs")


def outcomes_of(spark, sf, docs=None):
    # as the job does, from written documents: the few columns of the files are read several times
    pending = tables.staged(files.pending_files(docs_of(spark, sf) if docs is None else docs), "pending")
    return files.extract_files(pending, driver_tables.file_bytes(spark, sf), O.HOSTS, max_content_bytes=O.MAX_CONTENT)


def flat(docs: DataFrame) -> DataFrame:
    """Documents as scalar columns."""
    p = "payload."
    pairs = {
        "doc_id": "_id", "schema_version": "schemaVersion", "message_id": "messageId", "message_seq": "messageSeq",
        "from_id": "from", "to_id": "to", "channel_id": "channelId", "channel_type": "channelType", "space_id": "spaceId",
        "ts": "timestamp", "created_at": "createdAt", "raw_excluded": "rawExcluded", "source": "source",
        "payload_type": p + "type", "text_content": p + "text.content", "image_url": p + "image.url",
        "image_caption": p + "image.caption", "image_name": p + "image.name", "image_width": p + "image.width",
        "image_height": p + "image.height", "gif_url": p + "gif.url", "voice_url": p + "voice.url",
        "video_url": p + "video.url", "video_cover": p + "video.cover", "video_width": p + "video.width",
        "video_height": p + "video.height", "video_second": p + "video.second", "file_url": p + "file.url",
        "file_name": p + "file.name", "file_caption": p + "file.caption", "file_size": p + "file.size",
        "file_extension": p + "file.extension", "merge_count": p + "mergeForward.childCount",
        "rich_text": p + "richText.searchText", "payload_raw": "payloadRaw", "parent_id": "parentMessageId",
        "parent_type": "parentPayloadType", "virtual": "virtual", "sub_seq": "subSeq",
    }
    dash = F.lit("-")
    merged = F.array_join(
        F.transform(
            "payload.mergeForward.msgs",
            lambda m: F.concat_ws(
                "~",
                F.coalesce(m["messageId"].cast("string"), dash),
                F.coalesce(m["type"].cast("string"), dash),
                F.coalesce(m["searchText"], dash),
                F.coalesce(m["from"], dash),
                F.coalesce(m["timestamp"].cast("string"), dash),
            ),
        ),
        ";",
    )
    return docs.select(
        *[F.col(path).alias(name) for name, path in pairs.items()],
        F.array_join("visibles", "|").alias("visibles"),
        merged.alias("merge_text"),
    )


# ---- sources -----------------------------------------------------------------------
CURSORS = {"message": 1000000000500, "message1": 5, "message2": 200000000000, "message4": 1000000000004}
_above = " OR ".join(f"(shard_table = '{s}' AND id > {n})" for s, n in CURSORS.items())


@query(
    "scan_shards",
    O.R + f"""SELECT shard_table, id, message_id, message_seq, from_uid, channel_id, channel_type, setting, signal, timestamp,
    created_unix, payload FROM src WHERE {_above} OR shard_table = 'message3'""",
)
def _(spark, sf):
    return shards.scan(rows_of(spark, sf), CURSORS).withColumn("payload", F.col("payload").cast("string"))


# after a run: files with a text, and those that never will have one, are not pending any more
@query("files_pending", O.X + f"""SELECT doc_id AS message_id, file_url AS url, file_name AS name, file_extension AS extension, file_size AS size FROM docs
  WHERE payload_type = 8 AND doc_id NOT IN (SELECT message_id FROM extracted WHERE outcome = 'ok' OR outcome IN {O._in(C.TOMBSTONE_REASONS)})""")
def _(spark, sf):
    return files.pending_files(extracted_docs(written_docs(spark, sf), spark, sf))


@query("dlq_window_ids", O.L + f"SELECT DISTINCT message_id FROM letters WHERE message_id <> '' AND created_at BETWEEN {FROM} AND {MID}")
def _(spark, sf):
    return deadletters.window_ids(letters_of(spark, sf), FROM, MID)


@query("stored_files", O._with("store AS (" + driver_tables.file_bytes_sql() + ")") + "SELECT url, strlen(body) AS bytes FROM store")
def _(spark, sf):
    return driver_tables.file_bytes(spark, sf).select("url", F.octet_length("body").alias("bytes"))


# ---- enrichment ----------------------------------------------------------------------
@query("is_signal", O.R + "SELECT shard_table, encrypted, count(*) AS n FROM routed GROUP BY ALL")
def _(spark, sf):
    return rows_of(spark, sf).groupBy("shard_table", enrich.is_encrypted().alias("encrypted")).agg(F.count(F.lit(1)).alias("n"))


@query("payload_parse", O.R + "SELECT id, shard_table, body IS NOT NULL AS is_object FROM routed")
def _(spark, sf):
    return enrich.with_payload(rows_of(spark, sf)).select("id", "shard_table", F.col("body").isNotNull().alias("is_object"))


@query("content_type", O.R + "SELECT id, shard_table, content_type, content_type = 1 AS is_text FROM routed WHERE body IS NOT NULL")
def _(spark, sf):
    r = routed_of(spark, sf).select("id", "shard_table", "content_type", F.col("body").isNotNull().alias("ok"))
    return r.where("ok").select("id", "shard_table", "content_type", (F.col("content_type") == 1).alias("is_text"))


@query("route_outcome", O.R + "SELECT id, shard_table, outcome, reason FROM routed")
def _(spark, sf):
    return routed_of(spark, sf).select("id", "shard_table", "outcome", "reason")


@query(
    "visibility",
    O.R + """SELECT id, shard_table, vis_type IS NULL OR coalesce(len(names), 0) > 0 AS trusted,
    nullif(CASE WHEN json_type(body, '$.space_id') = 'VARCHAR' THEN json_extract_string(body, '$.space_id') END, '') AS space_id,
    CASE WHEN coalesce(len(names), 0) > 0 THEN array_to_string(names, '|') END AS visibles FROM routed WHERE body IS NOT NULL""",
)
def _(spark, sf):
    acl = enrich.visibility(F.col("body"))
    out = enrich.with_payload(rows_of(spark, sf)).select("id", "shard_table", F.col("body").isNotNull().alias("ok"), acl.alias("acl"))
    return out.where("ok").select(
        "id", "shard_table", "acl.trusted", jsonx.empty_as_null(F.col("acl.space_id")).alias("space_id"),
        jsonx.empty_as_null(F.array_join("acl.visibles", "|")).alias("visibles"),
    )


_MESSAGE_SQL = f"""SELECT 2 AS schema_version, message_id, seq AS message_seq, channel_id, channel_type, from_uid, content, content_type,
  CASE WHEN NOT encrypted THEN payload END AS raw_payload, outcome = 'raw_excluded' AS raw_excluded, space_id,
  array_to_string(visibles, '|') AS visibles, timestamp AS msg_timestamp, created_unix AS created_at, '{C.SOURCE_TAG}' AS source"""


@query("contract_rows", O.R + _MESSAGE_SQL + " FROM routed WHERE outcome <> 'dlq'")
def _(spark, sf):
    return messages_of(spark, sf, keep=()).withColumn("visibles", F.array_join("visibles", "|"))


# sizes in the SQL: JSON of the same fields, less the null ones, plus five bytes per escaped character
_ENV = {
    "schema_version": "2", "message_id": "message_id", "message_seq": "seq", "channel_id": "channel_id", "channel_type": "channel_type",
    "from_uid": "from_uid", "content": "content", "content_type": "content_type", "raw_excluded": "outcome = 'raw_excluded'",
    "space_id": "space_id", "visibles": "visibles", "msg_timestamp": "timestamp", "created_at": "created_unix", "source": f"'{C.SOURCE_TAG}'",
}
_env_json = "CAST(to_json({" + ", ".join(f"'{k}': {v}" for k, v in _ENV.items()) + "}) AS VARCHAR)"
_env_nulls = " + ".join(f"CASE WHEN ({v}) IS NULL THEN {len(k) + 8} ELSE 0 END" for k, v in _ENV.items())
_grow = "5 * (length({0}) - length(translate({0}, '<>&', '')))"
_SIZED = f"""sized AS (SELECT *, strlen({_env_json}) - ({_env_nulls}) + {_grow.format(_env_json)} AS env,
  CASE WHEN encrypted THEN 0 ELSE strlen(payload) + {_grow.format('payload')} + 15 END AS pay FROM routed WHERE outcome <> 'dlq'),
fitted AS (SELECT *, CASE WHEN env + pay <= {O.SMALL_MESSAGE} THEN 'whole' WHEN env <= {O.SMALL_ENVELOPE} THEN 'degraded' ELSE 'oversize' END AS fit FROM sized)"""
_FIT_SQL = _SIZED.replace(f"env <= {O.SMALL_ENVELOPE}", f"env <= {O.SMALL_MESSAGE}")


@query("oversize_degrade", O._with(O.SRC, O.ROUTED, _FIT_SQL) + "SELECT message_id, created_unix AS created_at, fit, CASE WHEN fit = 'whole' AND NOT encrypted THEN payload END AS raw_payload FROM fitted")
def _(spark, sf):
    fitted = limits.degrade_oversize(messages_of(spark, sf, keep=()), O.SMALL_MESSAGE)
    return fitted.select("message_id", "created_at", "fit", "raw_payload")


@query(
    "producer_dlq",
    O.R + f"""SELECT 1 AS schema_version, reason, shard_table, id AS source_id, message_id, channel_id, channel_type,
    CASE WHEN strlen(payload) <= {O.SMALL_DLQ} THEN payload END AS raw_payload,
    CASE WHEN strlen(payload) > {O.SMALL_DLQ} THEN '{C.PAYLOAD_DROPPED_NOTE}' END AS detail,
    created_unix AS created_at, timestamp AS msg_timestamp FROM routed WHERE reason IS NOT NULL""",
)
def _(spark, sf):
    bad = routed_of(spark, sf).where(F.col("reason").isNotNull())
    return deadletters.producer_letters(bad, limit=O.SMALL_DLQ).withColumn("raw_payload", F.col("raw_payload").cast("string"))


@query("decode_contract", O.R + "SELECT message_id, 2 AS schema_version, seq AS message_seq, content, content_type, outcome = 'raw_excluded' AS raw_excluded, space_id, array_to_string(visibles, '|') AS visibles, created_unix AS created_at, CAST(NULL AS VARCHAR) AS reason, CASE WHEN NOT encrypted THEN json_extract_string(payload, '$.url') END AS raw_url FROM routed WHERE outcome <> 'dlq'")
def _(spark, sf):
    decoded = wire.decode(wire.encode(messages_of(spark, sf, keep=()), "messages"))
    return decoded.select(
        "message_id", "schema_version", "message_seq", "content", "content_type", "raw_excluded", "space_id",
        F.array_join("visibles", "|").alias("visibles"), "created_at", "reason",
        F.get_json_object("raw_payload", "$.url").alias("raw_url"),
    )


# ---- documents -----------------------------------------------------------------------
_FLAT = ", ".join(O.DOC_FLAT)


@query("row_to_doc", O.D + f"SELECT {_FLAT} FROM docs")
def _(spark, sf):
    judged = historical.judged_rows(rows_of(spark, sf))
    return flat(enrich.unpacked(judged, "docs"))


@query(
    "doc_from_message",
    O.D + """SELECT CASE WHEN NOT encrypted THEN 'a' ELSE 'b' END AS branch, kind AS payload_kind, count(*) AS messages,
    count(DISTINCT num) AS ids FROM d2 GROUP BY ALL""",
)
def _(spark, sf):
    p = documents.with_projection(messages_of(spark, sf)).select("doc_number", "branch", F.col("doc_fields.type").alias("payload_kind"))
    return p.where("doc_number IS NOT NULL").groupBy("branch", "payload_kind").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("doc_number").alias("ids")
    )


def _projection(name: str, kinds: str, columns: list[str]):
    @query(name, O.D + f"SELECT doc_id, payload_type, {', '.join(columns)} FROM docs WHERE {kinds}")
    def _(spark, sf):
        return flat(docs_of(spark, sf)).where(kinds).select("doc_id", "payload_type", *columns)


_projection("project_text", "payload_type = 1", ["text_content", "raw_excluded"])
_projection("project_image", "payload_type = 2", ["image_url", "image_caption", "image_name", "image_width", "image_height"])
_projection("project_gif", "payload_type = 3", ["gif_url"])
_projection("project_voice", "payload_type = 4", ["voice_url"])
_projection("project_video", "payload_type = 5", ["video_url", "video_cover", "video_width", "video_height", "video_second"])
_projection("project_file", "payload_type = 8", ["file_url", "file_name", "file_caption", "file_size", "file_extension"])
_projection("project_merge_forward", "payload_type = 11", ["merge_count", "merge_text", "raw_excluded"])
_projection("rich_search_text", "payload_type = 14", ["rich_text", "sub_seq"])
_projection("raw_excluded", "raw_excluded", ["payload_raw"])
_projection("richtext_children", "virtual", ["message_id", "parent_id", "parent_type", "sub_seq", "visibles", "payload_raw", "image_url", "image_name", "image_width"])
_projection("omit_empty", "sub_seq = 0", ["message_seq", "from_id", "space_id", "visibles", "created_at", "sub_seq"])


@query("file_to_video", O.D + "SELECT doc_id, video_url, video_width FROM parents WHERE payload_type = 5 AND json_extract_string(payload_raw, '$.type') = '8'")
def _(spark, sf):
    docs = flat(docs_of(spark, sf)).where("payload_type = 5 AND sub_seq = 0")
    return docs.where(F.get_json_object("payload_raw", "$.type") == "8").select("doc_id", "video_url", "video_width")


@query("search_text", O.D + "SELECT doc_id, m.txt AS search_text, m.t AS inner_type FROM (SELECT CAST(num AS VARCHAR) AS doc_id, unnest(items) AS m FROM d2)")
def _(spark, sf):
    return docs_of(spark, sf).select(F.col("_id").alias("doc_id"), F.explode("payload.mergeForward.msgs").alias("m")).select(
        "doc_id", F.col("m.searchText").alias("search_text"), F.col("m.type").alias("inner_type")
    )


@query("rich_plain", O.D + f"SELECT CAST(num AS VARCHAR) AS doc_id, {O._plain('blocks')} AS plain FROM d2 WHERE blocks IS NOT NULL")
def _(spark, sf):
    p = documents.with_projection(messages_of(spark, sf)).select("doc_number", "doc_blocks")
    return p.where("doc_number IS NOT NULL AND doc_blocks IS NOT NULL").select(
        F.col("doc_number").cast("string").alias("doc_id"), documents.rich_plain(F.col("doc_blocks")).alias("plain")
    )


@query("reverse_peer", O.D + "SELECT doc_id, channel_id, from_id, to_id FROM parents WHERE channel_type = 1")
def _(spark, sf):
    return flat(docs_of(spark, sf)).where("channel_type = 1 AND sub_seq = 0").select("doc_id", "channel_id", "from_id", "to_id")


@query("numeric_id", O.R + "SELECT message_id, CASE WHEN regexp_matches(message_id, '^[+-]?[0-9]+$') THEN CAST(TRY_CAST(message_id AS BIGINT) AS VARCHAR) END AS doc_id, CASE WHEN NOT regexp_matches(message_id, '^[+-]?[0-9]+$') THEN 400 END AS status FROM routed WHERE outcome <> 'dlq'")
def _(spark, sf):
    return delivery.numeric_id(messages_of(spark, sf, keep=())).select("message_id", "doc_id", "status")


# no SQL twin: the size is that of the encoded document, tests compare it with a JSON encoder
@query("doc_oversize")
def _(spark, sf):
    big = limits.oversize_documents(docs_of(spark, sf), O.SMALL_DOC)
    return big.select(F.col("_id").alias("doc_id"), "status", "doc_bytes")


_LEGACY = """SELECT message_id, channel_id, channel_type, from_uid, timestamp AS msg_timestamp, created_unix AS created_at,
  outcome = 'raw_excluded' AS raw_excluded, 1 AS schema_version, CASE WHEN content_type <> 2 THEN coalesce(content, concat('flat ', from_uid)) END AS content, content_type
  FROM routed WHERE regexp_matches(message_id, '^[0-9]+$')"""


@query("migrate_legacy", O.R + f"SELECT message_id AS doc_id, CAST(message_id AS BIGINT) AS message_id, from_uid AS from_id, channel_id, channel_type, msg_timestamp AS ts, created_at, raw_excluded, schema_version, content_type AS payload_type, content AS text_content, 0 AS sub_seq FROM ({_LEGACY})")
def _(spark, sf):
    old = routed_of(spark, sf).where(F.col("message_id").rlike("^[0-9]+$")).select(
        "message_id", "channel_id", "channel_type", "from_uid", F.col("timestamp").alias("msg_timestamp"),
        F.col("created_unix").alias("created_at"), (F.col("outcome") == "raw_excluded").alias("raw_excluded"),
        F.lit(1).alias("schema_version"),
        F.when(F.col("content_type") != 2, F.coalesce("content", F.concat(F.lit("flat "), F.col("from_uid")))).alias("content"),
        "content_type",
    )
    return flat(documents.migrate_legacy(old)).select(
        "doc_id", "message_id", "from_id", "channel_id", "channel_type", "ts", "created_at", "raw_excluded", "schema_version",
        "payload_type", "text_content", "sub_seq",
    )


# ---- files -----------------------------------------------------------------------------
@query("file_messages", O.R + f"SELECT message_id, {O._str('body', 'url')} AS url, {O._str('body', 'name')} AS name, {O._str('body', 'extension')} AS extension, {O._int('body', 'size')} AS size FROM routed WHERE outcome <> 'dlq' AND NOT encrypted AND {O._int('body', 'type')} = 8")
def _(spark, sf):
    return files.file_messages(messages_of(spark, sf, keep=()))


_FILES = O._with(O.SRC, O.ROUTED, O.DOCS, O.OUTCOMES)


@query("ext_blacklist", _FILES + f"SELECT message_id, ext, ext IN {O._in(C.SKIPPED_EXTENSIONS)} AS skipped FROM f1")
def _(spark, sf):
    ext = textx.extension_field_first(F.col("extension"), F.col("name"))
    return files.pending_files(docs_of(spark, sf)).select("message_id", ext.alias("ext"), ext.isin(C.SKIPPED_EXTENSIONS).alias("skipped"))


@query("size_cutoff", _FILES + f"SELECT message_id, size FROM f0 WHERE size > {C.MAX_FILE_BYTES}")
def _(spark, sf):
    return files.pending_files(docs_of(spark, sf)).where(F.col("size") > C.MAX_FILE_BYTES).select("message_id", "size")


@query("url_allowlist", f"SELECT url, {O._SCHEME} AS scheme, {O._HOST} AS host, ({O._SCHEME} IN ('https') AND {O._HOST} LIKE 'www.%') AS allowed FROM pages")
def _(spark, sf):
    pages = driver_tables.tables(spark, sf)["pages"]
    host = netx.url_host(F.col("url"))
    return pages.select(
        "url", netx.url_scheme(F.col("url")).alias("scheme"), host.alias("host"),
        (netx.url_scheme(F.col("url")).isin("https") & host.like("www.%")).alias("allowed"),
    )


@query("url_refused", _FILES + f"SELECT message_id, url, {O._URL_OK} AS allowed FROM f0")
def _(spark, sf):
    return files.pending_files(docs_of(spark, sf)).select("message_id", "url", netx.url_allowed(F.col("url"), O.HOSTS).alias("allowed"))


_IP = "concat(CAST((event_id * 7) % 256 AS {0}), '.', CAST((event_id * 13) % 256 AS {0}), '.', CAST(user_id % 256 AS {0}), '.', CAST(event_id % 300 AS {0}))"


@query(
    "ip_blocklist",
    f"""SELECT event_id, ip, NOT (a <= 255 AND b <= 255 AND c <= 255 AND d <= 255) OR a = 10 OR a = 127 OR (a = 169 AND b = 254)
    OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168) OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 224 AND b = 0 AND c = 0)
    OR (a = 0 AND b = 0 AND c = 0 AND d = 0) AS blocked FROM (SELECT event_id, {_IP.format('VARCHAR')} AS ip, (event_id * 7) % 256 AS a,
    (event_id * 13) % 256 AS b, user_id % 256 AS c, event_id % 300 AS d FROM events)""",
)
def _(spark, sf):
    ips = driver_tables.tables(spark, sf)["events"].selectExpr("event_id", f"{_IP.format('STRING')} AS ip")
    return ips.select("event_id", "ip", netx.ip_blocked(F.col("ip")).alias("blocked"))


@query("extract_content", f"SELECT page_id, {O._html_text('html')} AS content FROM pages")
def _(spark, sf):
    pages = driver_tables.tables(spark, sf)["pages"]
    return pages.select("page_id", files.native_text(F.col("html").cast("binary"), F.lit("text/html")).alias("content"))


@query("truncate_utf8", f"SELECT doc_id, {O._cut('text', O.MAX_CONTENT)} AS content, strlen(text) > {O.MAX_CONTENT} AS truncated FROM documents")
def _(spark, sf):
    docs = driver_tables.tables(spark, sf)["documents"]
    return docs.select(
        "doc_id", textx.cut_utf8(F.col("text"), O.MAX_CONTENT).alias("content"), (F.octet_length("text") > O.MAX_CONTENT).alias("truncated")
    )


@query("blank_test", "SELECT doc_id, regexp_matches(regexp_replace(text, '[^\\s\\p{Z}\\p{N}]', '', 'g'), '^[\\s\\p{Z}]*$') AS blank FROM documents")
def _(spark, sf):
    docs = driver_tables.tables(spark, sf)["documents"]
    return docs.select("doc_id", textx.is_blank(F.regexp_replace("text", r"[^\s\p{Z}\p{N}]", "")).alias("blank"))


def _reversed_text(batches):
    """A stand-in for an external extractor: the whole bytes as text, backwards, with the extension it was asked for."""
    for batch in batches:
        text = [bytes(b).decode("utf-8", "replace")[::-1] + e for b, e in zip(batch["body"], batch["ext"])]
        yield batch[["url"]].assign(content=text, error_kind=None, extract_ms=1)


_BACKWARDS = "concat(array_to_string(list_reverse(regexp_extract_all(body, '(?s).')), ''), ext)"


# every stored file asked for under two extensions that only a plug-in reads
@query("extract_plugin", f"""WITH store AS ({driver_tables.file_bytes_sql()}), both_ AS (SELECT url, body, ext FROM store, (VALUES ('.pdf'), ('.docx')) e(ext)),
  texts AS (SELECT concat(url, ext) AS message_id, {_BACKWARDS} AS whole FROM both_)
  SELECT message_id, 'ok' AS outcome, {O._cut('whole', C.MAX_CONTENT_BYTES)} AS content, strlen(whole) > {C.MAX_CONTENT_BYTES} AS truncated FROM texts""")
def _(spark, sf):
    bodies = driver_tables.file_bytes(spark, sf)
    wanted = bodies.select("url", F.explode(F.array(F.lit(".pdf"), F.lit(".docx"))).alias("extension")).select(
        F.concat("url", "extension").alias("message_id"), "url", F.lit(None).cast("string").alias("name"), "extension", F.lit(None).cast("bigint").alias("size")
    )
    out = files.extract_files(tables.staged(wanted, "wanted"), bodies, O.HOSTS, extractor=_reversed_text)
    return out.select("message_id", "outcome", "content", "truncated")


@query("extract_route", O.X + "SELECT message_id, ext, outcome, content, truncated FROM extracted")
def _(spark, sf):
    return outcomes_of(spark, sf).select("message_id", "ext", "outcome", "content", "truncated")


@query("tombstone_reason", O.X + f"SELECT outcome, outcome IN {O._in(C.TOMBSTONE_REASONS)} AS permanent, count(*) AS files FROM extracted GROUP BY ALL")
def _(spark, sf):
    out = outcomes_of(spark, sf)
    return out.groupBy("outcome", files.is_permanent(F.col("outcome")).alias("permanent")).agg(F.count(F.lit(1)).alias("files"))


@query("mime_type", _FILES + "SELECT message_id, ext, mime FROM f2")
def _(spark, sf):
    pending = files.pending_files(docs_of(spark, sf))
    ext = textx.extension_field_first(F.col("extension"), F.col("name"))
    return pending.select("message_id", ext.alias("ext"), textx.mime_type(ext).alias("mime"))


@query("file_ext", _FILES + f"SELECT message_id, {O._name_first_ext('name', 'extension')} AS name_first, ext AS field_first FROM f1")
def _(spark, sf):
    e, n = F.col("extension"), F.col("name")
    return files.pending_files(docs_of(spark, sf)).select(
        "message_id", textx.extension_name_first(e, n).alias("name_first"), textx.extension_field_first(e, n).alias("field_first")
    )


# ---- delivery -----------------------------------------------------------------------------
_STATUSES = [200, 201, 429, 400, 409, 404, 413, 503, 0, 200, 200, 200]
_STATUS_SQL = "CASE ({0} % 12) " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(_STATUSES)) + " END"
_CLASS_SQL = "CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status BETWEEN 400 AND 499 AND status NOT IN (409, 429) THEN 'permanent' ELSE 'transient' END"


@query("status_class", f"SELECT event_id, status, {_CLASS_SQL} AS class FROM (SELECT event_id, {_STATUS_SQL.format('event_id')} AS status FROM events)")
def _(spark, sf):
    ev = driver_tables.tables(spark, sf)["events"].selectExpr("event_id", f"{_STATUS_SQL.format('event_id')} AS status")
    return ev.withColumn("class", delivery.status_class(F.col("status")))


@query("update_status_class", f"""SELECT event_id, status, CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 404 THEN 'doc_not_yet'
  WHEN status IN (409, 429, 0) OR status >= 500 THEN 'transient' ELSE 'os_permanent' END AS class FROM (SELECT event_id, {_STATUS_SQL.format('event_id')} AS status FROM events)""")
def _(spark, sf):
    ev = driver_tables.tables(spark, sf)["events"].selectExpr("event_id", f"{_STATUS_SQL.format('event_id')} AS status")
    return ev.withColumn("class", delivery.update_status_class(F.col("status")))


# deliveries: every row of every shard, shard as stream partition, id as offset; a status per row
def deliveries_of(spark, sf):
    rows = rows_of(spark, sf).select("shard_table", "id", "message_id", "created_unix")
    status = F.expr(_STATUS_SQL.format("(id % 1009)"))
    return rows.select(
        F.lit("messages").alias("topic"), F.col("shard_table").alias("partition"), F.col("id").alias("offset"), "message_id",
        status.alias("status"),
    ).withColumn("disposition", delivery.disposition(F.col("status")))


_DELIVERY = O._with(O.SRC, f"""dl AS (SELECT 'messages' AS topic, shard_table AS partition, id AS "offset", message_id, {_STATUS_SQL.format('(id % 1009)')} AS status FROM src),
dd AS (SELECT *, CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status BETWEEN 400 AND 499 AND status NOT IN (409, 429) THEN 'dlq_resolved' ELSE 'transient' END AS disposition FROM dl),
cp AS (SELECT topic, partition, max("offset") AS commit_offset FROM (SELECT *, sum(CASE WHEN disposition = 'transient' THEN 1 ELSE 0 END) OVER
  (PARTITION BY topic, partition ORDER BY "offset") AS open FROM dd) WHERE open = 0 GROUP BY ALL)""")


@query("commit_points", _DELIVERY + "SELECT * FROM cp")
def _(spark, sf):
    return stability.commit_points(deliveries_of(spark, sf))


@query("disposition_counts", _DELIVERY + "SELECT partition, disposition, count(*) AS items FROM dd GROUP BY ALL")
def _(spark, sf):
    return metrics.count_by(deliveries_of(spark, sf), "partition", "disposition")


@query("drain_check", _DELIVERY + """, ends AS (SELECT topic, partition, max("offset") + 1 AS end_offset FROM dd GROUP BY ALL)
  SELECT e.topic, count(*) AS partitions, CAST(sum(greatest(end_offset - 1 - coalesce(commit_offset, -1), 0)) AS BIGINT) AS open_items,
  bool_and(coalesce(commit_offset + 1 >= end_offset, end_offset = 0)) AS drained FROM ends e LEFT JOIN cp USING (topic, partition) GROUP BY e.topic""")
def _(spark, sf):
    items = deliveries_of(spark, sf)
    ends = items.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return stability.drained(ends, stability.commit_points(items))


@query(
    "indexer_dlq",
    _DELIVERY + f"""SELECT CASE WHEN status = 404 THEN '{C.INDEXER_SCHEMA}' ELSE '{C.INDEXER_PERMANENT}' END AS reason, topic, partition, "offset",
    message_id AS key, CASE WHEN strlen(payload) <= {O.SMALL_DLQ} THEN payload END AS value, CASE WHEN status = 404 THEN 0 ELSE status END AS status,
    concat_ws('; ', CASE WHEN status <> 404 THEN concat('status ', CAST(status AS VARCHAR)) END, CASE WHEN strlen(payload) > {O.SMALL_DLQ}
      THEN concat('value left out: ', CAST(strlen(payload) AS VARCHAR), ' bytes are over {O.SMALL_DLQ}; for a replay fetch the message of this key from its source') END) AS detail,
    strlen(payload) > {O.SMALL_DLQ} AS payload_truncated FROM dd JOIN (SELECT shard_table AS partition, id AS "offset", payload FROM src) USING (partition, "offset") WHERE disposition = 'dlq_resolved'""",
)
def _(spark, sf):
    rows = rows_of(spark, sf).withColumn("status", F.expr(_STATUS_SQL.format("(id % 1009)")))
    items = rows.where(delivery.disposition(F.col("status")) == delivery.DLQ).select(
        F.when(F.col("status") == 404, F.lit(C.INDEXER_SCHEMA)).otherwise(F.lit(C.INDEXER_PERMANENT)).alias("reason"),
        F.lit("messages").alias("topic"), F.col("shard_table").alias("partition"), F.col("id").alias("offset"),
        F.col("message_id").alias("key"), F.col("payload").alias("value"), "status",
        F.concat(F.lit("status "), F.col("status").cast("string")).alias("error"),
    )
    return deadletters.indexer_letters(items, O.SMALL_DLQ).withColumn("value", F.col("value").cast("string"))


@query(
    "file_dlq",
    _FILES + f"""SELECT outcome AS reason, message_id AS "messageId", url AS "fileURL", ext AS "fileExt", size AS "fileSize",
    decode(encode(concat(message_id, ' ', ext))[1:22]) AS value, strlen(concat(message_id, ' ', ext)) > 22 AS "payloadTruncated" FROM outcomes WHERE outcome <> 'ok'""",
)
def _(spark, sf):
    bad = outcomes_of(spark, sf).where("outcome <> 'ok'")
    items = bad.select(
        F.col("outcome").alias("reason"), F.lit("messages").alias("topic"), F.lit(0).alias("partition"), F.lit(0).alias("offset"),
        F.col("message_id").alias("key"), F.concat_ws(" ", "message_id", "ext").cast("binary").alias("value"), "message_id", "url",
        F.col("ext").alias("extension"), "size", F.lit("").alias("error"),
    )
    out = deadletters.file_letters(items, 22).withColumn("value", F.col("value").cast("string"))
    return out.select("reason", "messageId", "fileURL", "fileExt", "fileSize", "value", "payloadTruncated")


@query(
    "parent_result",
    O.D + f""", r AS (SELECT message_id AS parent_id, sub_seq, {_STATUS_SQL.format('((message_id // 1000 + sub_seq) % 1009)')} AS status FROM docs),
    k AS (SELECT *, {_CLASS_SQL} AS class FROM r)
    SELECT parent_id, count(*) AS documents, bool_and(class = 'ok') AS ok, coalesce(arg_min(status, sub_seq) FILTER (WHERE class <> 'ok'),
      max(status) FILTER (WHERE sub_seq = 0)) AS status FROM k GROUP BY parent_id""",
)
def _(spark, sf):
    docs = docs_of(spark, sf).selectExpr("messageId AS parent_id", "subSeq AS sub_seq")
    return delivery.parent_results(docs.withColumn("status", F.expr(_STATUS_SQL.format("((parent_id div 1000 + sub_seq) % 1009)"))))


@query(
    "retry_pass",
    f"""SELECT key, CASE WHEN state = 'retry_exhausted' THEN attempts ELSE attempts + 1 END AS attempts, state,
    CASE WHEN state = 'waiting' THEN {NOW} + CAST(ceil(least(pow(2, attempts), 60)) AS BIGINT) END AS next_attempt_at FROM (SELECT event_id AS key, user_id % 12 AS attempts,
    CASE WHEN user_id % 12 >= 10 THEN 'retry_exhausted' WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status BETWEEN 400 AND 499 AND status NOT IN (404, 409, 429) THEN 'os_permanent' ELSE 'waiting' END AS state
    FROM (SELECT event_id, user_id, {_STATUS_SQL.format('event_id')} AS status FROM events))""",
)
def _(spark, sf):
    ev = driver_tables.tables(spark, sf)["events"].selectExpr(
        "event_id AS key", "user_id % 12 AS attempts", f"{_STATUS_SQL.format('event_id')} AS status"
    )
    return delivery.retry_pass(ev, NOW, extraction.MAX_ATTEMPTS, extraction.BACKOFF_BASE, extraction.BACKOFF_CAP)


@query("backoff_cap", "SELECT event_id, least(0.5 * pow(2, user_id % 16), 30.0) AS wait FROM events")
def _(spark, sf):
    ev = driver_tables.tables(spark, sf)["events"].selectExpr("event_id", "user_id % 16 + 1 AS n")
    return ev.select("event_id", delivery.backoff_seconds(F.col("n"), 0.5, 30).alias("wait"))


# ---- prefix, cursors --------------------------------------------------------------------
_STABLE = O._with(O.SRC, O.ROUTED, f"""fresh AS (SELECT shard_table, min(id) AS first_bad FROM src WHERE created_unix > {NOW - O.LAG} GROUP BY 1),
st AS (SELECT r.* FROM routed r LEFT JOIN fresh f USING (shard_table) WHERE f.first_bad IS NULL OR r.id < f.first_bad)""")
_CUR = "cur AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {n})" for s, n in CURSORS.items()) + ", ('message3', 0)) t(shard_table, last_id))"


def cursors_of(spark):
    return spark.createDataFrame([*CURSORS.items(), ("message3", 0)], "shard_table string, last_id bigint")


@query("stable_prefix", _STABLE + "SELECT shard_table, id, created_unix FROM st")
def _(spark, sf):
    return stability.stable_prefix(rows_of(spark, sf), NOW - O.LAG).select("shard_table", "id", "created_unix")


@query("advance_cursor", _STABLE + f", {_CUR} SELECT shard_table, max(last_id) AS last_id FROM (SELECT * FROM cur UNION ALL SELECT shard_table, max(id) FROM st GROUP BY 1) GROUP BY 1")
def _(spark, sf):
    stable = stability.stable_prefix(rows_of(spark, sf), NOW - O.LAG)
    return stability.advance(cursors_of(spark), stability.next_cursors(stable))


@query("cursor_lag", O._with(O.SRC, _CUR) + "SELECT cur.shard_table, coalesce(max(id), 0) AS source_max_id, last_id, coalesce(max(id), 0) - last_id AS lag FROM cur LEFT JOIN src ON cur.shard_table = src.shard_table GROUP BY cur.shard_table, last_id")
def _(spark, sf):
    return stability.cursor_lag(rows_of(spark, sf), cursors_of(spark))


# arrival order by creation time and id: conversations and files interleave, ids do not ascend
@query("order_tripwire", O._with(O.SRC) + """SELECT shard_table, arrival, prev_id, id FROM (SELECT *, row_number() OVER (PARTITION BY shard_table ORDER BY arrival) AS n FROM
  (SELECT shard_table, created_unix * 2000000000000 + id AS arrival, id, lag(id) OVER (PARTITION BY shard_table ORDER BY created_unix * 2000000000000 + id) AS prev_id FROM
  (SELECT shard_table, created_unix - 1704000000 AS created_unix, id FROM src)) WHERE id <= prev_id) WHERE n = 1""")
def _(spark, sf):
    rows = rows_of(spark, sf).select(
        "shard_table", "id", ((F.col("created_unix") - 1704000000) * 2000000000000 + F.col("id")).alias("arrival")
    )
    return stability.order_violations(rows)


@query(
    "incremental_run",
    _STABLE + """SELECT shard_table, max(id) AS cursor, count(*) FILTER (WHERE outcome <> 'dlq') AS main, count(*) FILTER (WHERE outcome = 'dlq') AS dlq FROM st GROUP BY 1""",
)
def _(spark, sf):
    """One real tick: records and letters are written, then the cursor moves."""
    out = new_work_dir(spark, "tick")
    pointer = VersionedPointer(spark, f"{out}/cursors")
    moved = incremental.run_tick(rows_of(spark, sf), pointer, out, NOW, O.LAG)
    spots = spark.createDataFrame(list(moved.items()), "shard_table string, cursor bigint")
    ids = rows_of(spark, sf).select("shard_table", "message_id", "created_unix")
    written = incremental.main_records(spark, out, pointer).select(
        F.col("key").cast("string").alias("message_id"), F.get_json_object(F.col("value").cast("string"), "$.created_at").cast("bigint").alias("created_unix")
    )
    main = ids.join(written, ["message_id", "created_unix"], "left_semi").groupBy("shard_table").agg(F.count(F.lit(1)).alias("main"))
    dead = incremental.dead_records(spark, out, pointer).groupBy("shard_table").agg(F.count(F.lit(1)).alias("dlq"))
    return spots.join(main, "shard_table", "left").join(dead, "shard_table", "left").select("shard_table", "cursor", "main", "dlq")


@query(
    "incremental_stream",
    _STABLE + """SELECT shard_table, max(id) AS cursor, count(*) FILTER (WHERE outcome <> 'dlq') AS main, count(*) FILTER (WHERE outcome = 'dlq') AS dlq FROM st GROUP BY 1""",
)
def _(spark, sf):
    """The shards as a stream: a first run up to an earlier frontier, then one that goes on from its checkpoint."""
    out = new_work_dir(spark, "shard-stream")
    pointer, frontier = VersionedPointer(spark, f"{out}/cursors"), VersionedPointer(spark, f"{out}/frontier")
    source = lambda: rows_of(spark, sf)
    for now in (NOW - 10 * O.LAG, NOW):
        shardstream.publish(source(), frontier, now, O.LAG)
        producing.start(source, f"{out}/frontier", pointer, out, f"{out}/progress", lambda: NOW).awaitTermination()
    moved = incremental.progress(pointer)[1]["cursors"]
    spots = spark.createDataFrame(list(moved.items()), "shard_table string, cursor bigint")
    ids = source().select("shard_table", "message_id", "created_unix")
    written = incremental.main_records(spark, out, pointer).select(
        F.col("key").cast("string").alias("message_id"), F.get_json_object(F.col("value").cast("string"), "$.created_at").cast("bigint").alias("created_unix")
    )
    main = written.join(ids, ["message_id", "created_unix"]).groupBy("shard_table").agg(F.count(F.lit(1)).alias("main"))
    dead = incremental.dead_records(spark, out, pointer).groupBy("shard_table").agg(F.count(F.lit(1)).alias("dlq"))
    return spots.join(main, "shard_table", "left").join(dead, "shard_table", "left").select("shard_table", "cursor", "main", "dlq")


@query("produced_by_stream", _STABLE + "SELECT CASE WHEN outcome = 'dlq' THEN 'dlq' ELSE 'main' END AS leg, count(*) AS items FROM st GROUP BY ALL")
def _(spark, sf):
    return metrics.count_by(incremental.planned(rows_of(spark, sf), NOW, O.LAG), "leg")


# ---- dead letters ---------------------------------------------------------------------------
# two deliveries of the same letters: the second as of another table name
_TWICE = """twice AS (SELECT tbl, id, message_id, created_at, reason, CASE WHEN message_id LIKE 'm-%' THEN '' ELSE message_id END AS mid FROM letters
  UNION ALL SELECT 'again', id, message_id, created_at, 'again', CASE WHEN message_id LIKE 'm-%' THEN '' ELSE message_id END FROM letters),
keyed AS (SELECT *, CASE WHEN mid <> '' THEN mid ELSE concat(tbl, ':', CAST(id AS VARCHAR)) END AS dedup_key FROM twice),
ranked AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY tbl, id, created_at, reason) AS n FROM keyed)"""


def twice_of(spark, sf):
    letters = letters_of(spark, sf).select("table", "id", "message_id", "created_at", "reason")
    # the fixture's textual ids stand for rows without an id
    letters = letters.withColumn("message_id", F.when(F.col("message_id").like("m-%"), "").otherwise(F.col("message_id")))
    again = letters.withColumn("table", F.lit("again")).withColumn("reason", F.lit("again"))
    return letters.unionByName(again)


@query("dlq_dedup", O._with(O.SRC, O.ROUTED, O.LETTERS, _TWICE) + 'SELECT dedup_key, tbl AS "table", id, reason, created_at FROM ranked WHERE n = 1')
def _(spark, sf):
    return deadletters.first_per_key(twice_of(spark, sf)).select("dedup_key", "table", "id", "reason", "created_at")


@query("dlq_spill_dedup", O._with(O.SRC, O.ROUTED, O.LETTERS, _TWICE) + f"""SELECT dedup_key, tbl AS "table", id, reason FROM ranked WHERE n = 1
  AND dedup_key NOT IN (SELECT dedup_key FROM keyed WHERE created_at <= {MID})""")
def _(spark, sf):
    letters = twice_of(spark, sf)
    stored = letters.where(F.col("created_at") <= MID)
    return deadletters.new_letters(letters, stored).select("dedup_key", "table", "id", "reason")


@query("dlq_count_window", O.L + f"SELECT count(DISTINCT dedup_key) AS dlq_keys FROM letters WHERE created_at BETWEEN {FROM} AND {MID}")
def _(spark, sf):
    return deadletters.window_count(letters_of(spark, sf), FROM, MID)


@query("dlq_by_reason", O._with(O.SRC, O.ROUTED, O.LETTERS, O.DOCS, O.OUTCOMES) + """SELECT 'load' AS leg, reason, count(*) AS records FROM letters GROUP BY ALL UNION ALL
  SELECT 'producer', reason, count(*) FROM routed WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'files', outcome, count(*) FROM outcomes WHERE outcome <> 'ok' GROUP BY ALL""")
def _(spark, sf):
    return deadletters.count_by_reason(
        {
            "load": letters_of(spark, sf),
            "producer": routed_of(spark, sf).where(F.col("reason").isNotNull()),
            "files": outcomes_of(spark, sf).where("outcome <> 'ok'").select(F.col("outcome").alias("reason")),
        }
    )


# ---- keyed writes ------------------------------------------------------------------------
# an older table (first half of the time, texts extracted, bundles renamed since) meets an overlapping redelivery
_UPSERT = f"""old AS (SELECT d.doc_id, d.payload_type, d.created_at, 'old' AS origin, x.content, CASE WHEN x.outcome = 'ok' THEN '-' WHEN x.outcome IN {O._in(C.TOMBSTONE_REASONS)} THEN x.outcome END AS mark
  FROM docs d LEFT JOIN extracted x ON d.doc_id = x.message_id AND d.payload_type = 8 WHERE d.created_at <= {TO}),
new AS (SELECT doc_id, payload_type, created_at FROM docs WHERE created_at >= {FROM + 300})"""


def extracted_docs(docs, spark, sf):
    return upsert.partial_update(docs, file_backfill.file_updates(outcomes_of(spark, sf, docs), NOW))


@query(
    "upsert_docs",
    O._with(O.SRC, O.ROUTED, O.DOCS, O.OUTCOMES, _UPSERT)
    + """SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN 'old' ELSE 'new' END AS origin, coalesce(n.payload_type, o.payload_type) AS payload_type,
    o.content, CASE WHEN o.mark = '-' THEN NULL ELSE o.mark END AS reason, o.mark IS NOT NULL AS has_meta FROM old o FULL JOIN new n ON o.doc_id = n.doc_id""",
)
def _(spark, sf):
    docs = written_docs(spark, sf)
    old = extracted_docs(docs, spark, sf).where(F.col("createdAt") <= TO).withColumn("source", F.lit("old"))
    new = docs.where(F.col("createdAt") >= FROM + 300).withColumn("source", F.lit("new"))
    out = upsert.upsert(old, new)
    return out.select(
        F.col("_id").alias("doc_id"), F.col("source").alias("origin"), F.col("payload.type").alias("payload_type"),
        F.col("payload.file.content").alias("content"), F.col("payload.file.contentMeta.reason").alias("reason"),
        F.col("payload.file.contentMeta").isNotNull().alias("has_meta"),
    )


@query("apply_file_content", O.X + f"SELECT message_id AS doc_id, content, truncated, {NOW} AS extracted_at FROM extracted WHERE outcome = 'ok'")
def _(spark, sf):
    stored = written_docs(spark, sf)
    updates = file_backfill.file_updates(outcomes_of(spark, sf, stored).where("outcome = 'ok'"), NOW)
    docs = upsert.partial_update(stored, updates).where(F.col("payload.file.content").isNotNull())
    m = "payload.file.contentMeta."
    return docs.select(
        F.col("_id").alias("doc_id"), F.col("payload.file.content").alias("content"), F.col(m + "truncated").alias("truncated"),
        F.col(m + "extractedAt").alias("extracted_at"),
    )


@query("apply_tombstones", O.X + f"SELECT message_id AS doc_id, 'unextractable' AS status, outcome AS reason, CAST(NULL AS VARCHAR) AS content FROM extracted WHERE outcome IN {O._in(C.TOMBSTONE_REASONS)}")
def _(spark, sf):
    stored = written_docs(spark, sf)
    bad = outcomes_of(spark, sf, stored).where("outcome <> 'ok'").select(F.col("message_id").alias("_id"), F.col("outcome").alias("reason"), F.lit(NOW).alias("extracted_at"))
    docs = upsert.partial_update(stored, upsert.tombstones(bad))
    return docs.where(F.col("payload.file.contentMeta.status").isNotNull()).select(
        F.col("_id").alias("doc_id"), F.col("payload.file.contentMeta.status").alias("status"),
        F.col("payload.file.contentMeta.reason").alias("reason"), F.col("payload.file.content").alias("content"),
    )


@query("partial_update", O.X + f"SELECT message_id AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'doc_not_yet' ELSE 'ok' END AS outcome FROM (SELECT * FROM extracted WHERE outcome = 'ok') x LEFT JOIN (SELECT doc_id FROM docs WHERE created_at >= {FROM + 100}) d ON x.message_id = d.doc_id")
def _(spark, sf):
    """Texts against a table that lacks its earliest documents."""
    stored = written_docs(spark, sf)
    updates = file_backfill.file_updates(outcomes_of(spark, sf, stored).where("outcome = 'ok'"), NOW)
    docs = stored.where(F.col("createdAt") >= FROM + 100)
    done = upsert.partial_update(docs, updates).where(F.col("payload.file.content").isNotNull()).select("_id", F.lit("ok").alias("outcome"))
    return done.unionByName(upsert.unmatched_updates(docs, updates)).withColumnRenamed("_id", "doc_id")


@query("doc_latest", O.D + """SELECT doc_id, source, partition FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY partition DESC, spot DESC) AS place FROM (
  SELECT doc_id, 'first' AS source, (message_id // 1000) % 3 AS partition, coalesce(message_seq, 0) AS spot FROM docs
  UNION ALL SELECT doc_id, 'second', (message_id // 1000 + 1) % 3, coalesce(message_seq, 0) + 1 FROM docs
  UNION ALL SELECT doc_id, 'third', (message_id // 1000) % 3, coalesce(message_seq, 0) + 2 FROM docs)) WHERE place = 1""")
def _(spark, sf):
    # every message is delivered three times; which delivery is the last depends on its number
    number, seq = F.expr("messageId div 1000"), F.coalesce("messageSeq", F.lit(0))
    copy = lambda name, part, offset: F.struct(F.lit(name).alias("source"), part.cast("int").alias("partition"), offset.alias("offset"))
    copies = F.array(copy("first", number % 3, seq), copy("second", (number + 1) % 3, seq + 1), copy("third", number % 3, seq + 2))
    all_ = docs_of(spark, sf).select(F.col("_id").alias("doc_id"), F.inline(copies))
    return delivery.latest_delivery(all_, "doc_id", ["partition", "offset"]).select("doc_id", "source", "partition")


# ---- reconcile ----------------------------------------------------------------------------
@query("source_count", O._with(O.SRC) + f"SELECT shard_table, count(*) AS source_rows FROM src WHERE created_unix BETWEEN {FROM} AND {TO} GROUP BY 1")
def _(spark, sf):
    return recon.source_count(rows_of(spark, sf), FROM, TO)


@query("doc_count", O.D + f"SELECT count(*) FILTER (WHERE NOT coalesce(virtual, FALSE)) AS doc_count FROM docs WHERE created_at BETWEEN {FROM} AND {TO}")
def _(spark, sf):
    return recon.doc_counts(docs_of(spark, sf), FROM, TO).select("doc_count")


@query("raw_excluded_count", O.D + f"SELECT count(*) FILTER (WHERE raw_excluded) AS raw_excluded FROM docs WHERE created_at BETWEEN {FROM} AND {TO}")
def _(spark, sf):
    return recon.doc_counts(docs_of(spark, sf), FROM, TO).select("raw_excluded")


_COUNTS = f"""c AS (SELECT (SELECT count(*) FROM src WHERE created_unix BETWEEN {FROM} AND {TO}) AS source_rows,
  (SELECT count(*) FROM docs WHERE NOT coalesce(virtual, FALSE) AND created_at BETWEEN {FROM} AND {TO}) AS doc_count,
  (SELECT count(*) FROM docs WHERE raw_excluded AND created_at BETWEEN {FROM} AND {TO}) AS raw_excluded,
  (SELECT count(DISTINCT dedup_key) FROM letters WHERE created_at BETWEEN {FROM} AND {TO}) AS dlq_keys)"""


@query("reconcile", O._with(O.SRC, O.ROUTED, O.DOCS, O.LETTERS, _COUNTS) + """SELECT *, source_rows - dlq_keys AS expected, doc_count - (source_rows - dlq_keys) AS diff,
  CASE WHEN doc_count = source_rows - dlq_keys THEN 'ok' ELSE 'mismatch' END AS verdict FROM c""")
def _(spark, sf):
    return reconcile.verdict(rows_of(spark, sf), docs_of(spark, sf), letters_of(spark, sf), FROM, TO)


# a table that drifted: channels of gifs changed, lists of system messages reversed or cut, voices lost
_DRIFT = """drift AS (SELECT doc_id, message_id, message_seq, CASE WHEN payload_type = 3 THEN concat(channel_id, 'x') ELSE channel_id END AS channel_id,
  channel_type, space_id, CASE WHEN payload_type = 99 THEN 'u_admin' WHEN visibles IS NOT NULL THEN array_to_string(list_reverse(string_split(visibles, '|')), '|') END AS visibles
  FROM docs WHERE payload_type IS DISTINCT FROM 4)"""
_COMPARED = """exp AS (SELECT r.* FROM routed r WHERE message_id <> '' AND message_id NOT IN (SELECT message_id FROM letters)),
lists AS (SELECT e.*, d.doc_id, d.message_id AS d_message_id, d.message_seq AS d_seq, d.channel_id AS d_channel, d.channel_type AS d_type, d.space_id AS d_space,
  concat('[', coalesce(array_to_string(list_sort(visibles_e), ' '), ''), ']') AS e_list, concat('[', coalesce(array_to_string(list_sort(string_split(d.visibles, '|')), ' '), ''), ']') AS d_list
  FROM (SELECT *, visibles AS visibles_e FROM exp) e LEFT JOIN drift d ON e.message_id = d.doc_id),
details AS (SELECT message_id, '_doc' AS field, 'present' AS source, 'missing' AS doc FROM lists WHERE doc_id IS NULL
 UNION ALL SELECT message_id, 'messageId', message_id, CAST(d_message_id AS VARCHAR) FROM lists WHERE doc_id IS NOT NULL AND message_id <> CAST(d_message_id AS VARCHAR)
 UNION ALL SELECT message_id, 'messageSeq', CAST(message_seq AS VARCHAR), CAST(coalesce(d_seq, 0) AS VARCHAR) FROM lists WHERE doc_id IS NOT NULL AND message_seq <> coalesce(d_seq, 0)
 UNION ALL SELECT message_id, 'channelId', channel_id, d_channel FROM lists WHERE doc_id IS NOT NULL AND channel_id <> d_channel
 UNION ALL SELECT message_id, 'channelType', CAST(channel_type AS VARCHAR), CAST(d_type AS VARCHAR) FROM lists WHERE doc_id IS NOT NULL AND channel_type <> d_type
 UNION ALL SELECT message_id, 'spaceId', coalesce(space_id, ''), coalesce(d_space, '') FROM lists WHERE doc_id IS NOT NULL AND NOT encrypted AND coalesce(space_id, '') <> coalesce(d_space, '')
 UNION ALL SELECT message_id, 'visibles', e_list, d_list FROM lists WHERE doc_id IS NOT NULL AND NOT encrypted AND e_list <> d_list)"""
_CMP = O._with(O.SRC, O.ROUTED, O.DOCS, O.LETTERS, _DRIFT, _COMPARED)


def drifted_of(spark, sf):
    docs = docs_of(spark, sf)
    kind = F.col("payload.type")
    return (
        docs.where(~kind.eqNullSafe(F.lit(4)))
        .withColumn("channelId", F.when(kind == 3, F.concat("channelId", F.lit("x"))).otherwise(F.col("channelId")))
        .withColumn("visibles", F.when(kind == 99, F.array(F.lit("u_admin"))).otherwise(F.reverse("visibles")))
    )


def expected_of(spark, sf, limit=None):
    excluded = deadletters.window_ids(letters_of(spark, sf), 0, 2**40)
    picked = recon.comparable_sample(rows_of(spark, sf), excluded, 0, 2**40, limit)
    return tables.staged(recon.expected_fields(picked), "expected")


@query("sample_compare", _CMP + "SELECT * FROM details")
def _(spark, sf):
    return recon.compare(expected_of(spark, sf), drifted_of(spark, sf))


@query("sample_exclude", _CMP + "SELECT message_id, shard_table, id FROM exp ORDER BY message_id, shard_table, id LIMIT 300")
def _(spark, sf):
    return expected_of(spark, sf, 300).select("message_id", "shard_table", "id")


@query("mismatch_details", _CMP + "SELECT * FROM details ORDER BY message_id, field LIMIT 50")
def _(spark, sf):
    return recon.first_details(recon.compare(expected_of(spark, sf), drifted_of(spark, sf)))


@query("sample_health", _CMP + """SELECT (SELECT count(*) FROM exp) AS sampled, (SELECT count(DISTINCT message_id) FROM details WHERE field = '_doc') AS missing,
  (SELECT count(DISTINCT message_id) FROM details WHERE field <> '_doc') AS mismatch""")
def _(spark, sf):
    expected = expected_of(spark, sf)
    return recon.sample_health(expected, recon.compare(expected, drifted_of(spark, sf)))


@query("sample_topk", O._with(O.SRC) + f"SELECT message_id, shard_table, id, created_unix FROM src WHERE created_unix BETWEEN {FROM} AND {TO} ORDER BY message_id, shard_table, id LIMIT 500")
def _(spark, sf):
    return recon.sample(rows_of(spark, sf), FROM, TO, 500).select("message_id", "shard_table", "id", "created_unix")


@query("recon_push_payload", O._with(O.SRC, O.ROUTED, O.DOCS, O.LETTERS, _DRIFT, _COMPARED, _COUNTS) + f"""SELECT doc_count AS es_doc_count, source_rows AS mysql_row_count,
  (SELECT count(DISTINCT message_id) FROM details) AS sample_mismatch, {NOW} AS ran_at_unix_seconds FROM c""")
def _(spark, sf):
    expected = expected_of(spark, sf)
    health = recon.sample_health(expected, recon.compare(expected, drifted_of(spark, sf)))
    verdict = reconcile.verdict(rows_of(spark, sf), docs_of(spark, sf), letters_of(spark, sf), FROM, TO)
    return recon.push_payload(recon.full_report(verdict, health), NOW)


# a table in which the documents without a search form are there twice
@query("doc_order_unique", O.D + """SELECT ts AS timestamp, message_id AS "messageId", sub_seq AS "subSeq", count(*) AS documents
  FROM (SELECT ts, message_id, sub_seq FROM docs UNION ALL SELECT ts, message_id, sub_seq FROM docs WHERE raw_excluded) GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    docs = docs_of(spark, sf)
    return recon.order_clashes(docs.unionByName(docs.where("rawExcluded")))


@query("visibles_equal", O.R + "SELECT id, shard_table, list_sort(visibles) = list_sort(list_concat(visibles[2:], visibles[1:1])) AS rotated_same, list_sort(visibles) = list_sort(list_distinct(visibles)) AS distinct_same FROM routed WHERE visibles IS NOT NULL")
def _(spark, sf):
    r = routed_of(spark, sf).select("id", "shard_table", F.when(F.col("reason").isNull(), F.col("acl.visibles")).alias("v")).where("v IS NOT NULL")
    n = F.size("v")
    rotated = F.concat(F.slice("v", F.lit(2), n), F.slice("v", F.lit(1), F.lit(1)))
    return r.select(
        "id", "shard_table", recon.lists_equal(F.col("v"), rotated).alias("rotated_same"),
        recon.lists_equal(F.col("v"), F.array_distinct("v")).alias("distinct_same"),
    )


# ---- metrics -------------------------------------------------------------------------------
@query(
    "backfill_stats",
    O.R + """, o AS (SELECT shard_table, outcome, outcome = 'dlq' OR NOT regexp_matches(message_id, '^[+-]?[0-9]+$') AS bad, id % 1009 = 7 AS rejected FROM routed)
    SELECT coalesce(shard_table, '*') AS shard_table, count(*) AS read, count(*) FILTER (WHERE NOT bad AND NOT rejected) AS indexed,
    count(*) FILTER (WHERE NOT bad AND outcome = 'raw_excluded') AS raw_excluded, count(*) FILTER (WHERE bad OR rejected) AS dlq,
    count(*) FILTER (WHERE bad) AS dlq_payload, count(*) FILTER (WHERE NOT bad AND rejected) AS dlq_permanent FROM o GROUP BY ROLLUP (shard_table)""",
)
def _(spark, sf):
    out = routed_of(spark, sf).select(
        "shard_table", "outcome", jsonx.integer_text(F.col("message_id")).isNotNull().alias("convertible"), (F.col("id") % 1009 == 7).alias("rejected")
    )
    return metrics.load_stats(out)


_LE = "(VALUES " + ", ".join(f"('{float(b)}', {float(b)})" for b in C.LATENCY_BUCKETS) + ", ('+Inf', 1e18)) b(le, bound)"


@query(
    "latency_histogram",
    O.D + f""", w AS (SELECT 'e2e' AS stage, greatest(seen - created_at, 0) AS v FROM (SELECT *, created_at + (message_seq * 37) % 2400 - 60 AS seen FROM docs WHERE message_seq IS NOT NULL) WHERE created_at > 0
    UNION ALL SELECT 'send_to_index', greatest(seen - ts, 0) FROM (SELECT *, created_at + (message_seq * 37) % 2400 - 60 AS seen FROM docs WHERE message_seq IS NOT NULL) WHERE ts > 0)
    SELECT stage, le, count(*) FILTER (WHERE v <= bound) AS n, CAST(sum(v) AS BIGINT) AS sum, count(*) AS count FROM w, {_LE} GROUP BY stage, le""",
)
def _(spark, sf):
    docs = docs_of(spark, sf).select("createdAt", "timestamp", (F.col("createdAt") + (F.col("messageSeq") * 37) % 2400 - 60).alias("indexed_unix"))
    return metrics.latency_histogram(docs)


_BYTES = "(VALUES " + ", ".join(f"('{float(b)}', {float(b)})" for b in C.CONTENT_BUCKETS) + ", ('+Inf', 1e18)) b(le, bound)"


@query(
    "content_bytes_histogram",
    f"""WITH w AS (SELECT strlen({O._cut('text', O.MAX_CONTENT)}) AS v, strlen(text) > {O.MAX_CONTENT} AS cut FROM documents)
    SELECT 'content' AS series, le, count(*) FILTER (WHERE v <= bound) AS n, CAST(sum(v) AS BIGINT) AS sum, count(*) AS count FROM w, {_BYTES} GROUP BY le
    UNION ALL SELECT 'truncated', NULL, count(*) FILTER (WHERE cut), NULL, NULL FROM w""",
)
def _(spark, sf):
    docs = driver_tables.tables(spark, sf)["documents"]
    cut = docs.select(textx.cut_utf8(F.col("text"), O.MAX_CONTENT).alias("content"), (F.octet_length("text") > O.MAX_CONTENT).alias("truncated"))
    return metrics.content_histogram(cut)


@query("file_backfill_gate", O.X + """SELECT count(*) AS scanned, count(*) FILTER (WHERE outcome = 'ok') AS extracted, count(*) FILTER (WHERE outcome NOT IN ('ok', 'no_extractor')) AS dlq,
  count(*) FILTER (WHERE outcome = 'no_extractor') AS transient, CASE WHEN count(*) FILTER (WHERE outcome = 'no_extractor') > 0 THEN 'open_items'
  WHEN count(*) FILTER (WHERE outcome <> 'ok') > 0.1 * count(*) THEN 'too_many_dead_letters' ELSE 'ok' END AS verdict FROM extracted""")
def _(spark, sf):
    return files.backfill_gate(outcomes_of(spark, sf))


# ---- search -------------------------------------------------------------------------------
@query("term_query", O.D + f"SELECT doc_id FROM docs WHERE channel_id = 'g7' OR payload_type = 5 OR (virtual AND image_url LIKE '%') OR file_extension = 'pdf' OR list_contains(string_split(visibles, '|'), 'admin')")
def _(spark, sf):
    hit = (
        search.term("channelId", "g7") | search.term("payload.type", 5) | search.term("virtual", True)
        | search.term("payload.file.extension", "pdf") | search.term("visibles", "admin")
    )
    return docs_of(spark, sf).where(hit).select(F.col("_id").alias("doc_id"))


def _words(col: str) -> str:
    """Letter and digit runs; a run of Han characters gives its pairs."""
    runs = f"regexp_extract_all(lower({col}), '\\p{{Han}}+|[\\p{{Latin}}\\p{{Greek}}\\p{{Cyrillic}}\\p{{N}}]+')"
    return f"""flatten(list_transform({runs}, lambda r: CASE WHEN regexp_matches(r, '^\\p{{Han}}{{2,}}$')
      THEN list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) ELSE [r] END))"""


@query("match_query", O.D + f"SELECT doc_id, text_content FROM docs WHERE text_content IS NOT NULL AND list_has_any({_words('text_content')}, ['signup', '改期', 'the'])")
def _(spark, sf):
    """Words looked up in the stored index, the documents found by id in the store."""
    root = new_work_dir(spark, "match")
    store = DocumentStore(spark, f"{root}/docs", **SLOTS)
    store.upsert(docs_of(spark, sf))
    index = SearchIndex(store, f"{root}/index")
    index.update()
    found = store.read_ids(index.match("Signup 改期 the", "payload.text.content"))
    return found.select(F.col("_id").alias("doc_id"), F.col("payload.text.content").alias("text_content"))


@query("bool_query", O.D + f"SELECT doc_id FROM docs WHERE created_at BETWEEN {FROM} AND {MID} AND channel_type = 2 AND NOT coalesce(virtual, FALSE) AND NOT coalesce(raw_excluded, FALSE)")
def _(spark, sf):
    return docs_of(spark, sf).where(
        search.all_of(search.between("createdAt", FROM, MID), search.term("channelType", 2), search.none_of(search.term("virtual", True), F.col("rawExcluded")))
    ).select(F.col("_id").alias("doc_id"))


@query("exists_query", O.D + "SELECT doc_id FROM docs WHERE file_name IS NOT NULL OR to_id IS NOT NULL OR space_id IS NOT NULL")
def _(spark, sf):
    return docs_of(spark, sf).where(search.exists("payload.file.name") | search.exists("to") | search.exists("spaceId")).select(F.col("_id").alias("doc_id"))


@query("ids_query", O.D + "SELECT doc_id, message_seq FROM docs WHERE doc_id IN (SELECT message_id FROM src WHERE channel_type = 1)")
def _(spark, sf):
    store = DocumentStore(spark, new_work_dir(spark, "ids"), **SLOTS)
    store.upsert(docs_of(spark, sf))
    ids = rows_of(spark, sf).where("channel_type = 1").select(F.col("message_id").alias("doc_id"))
    return store.read_ids(ids).select(F.col("_id").alias("doc_id"), F.col("messageSeq").alias("message_seq"))


@query("range_query", O.D + f"SELECT doc_id, created_at FROM docs WHERE created_at BETWEEN {FROM + 86400} AND {MID}")
def _(spark, sf):
    return docs_of(spark, sf).where(search.between("createdAt", FROM + 86400, MID)).select(F.col("_id").alias("doc_id"), F.col("createdAt").alias("created_at"))


@query(
    "inverted_index",
    O.X + f""", texts AS (SELECT doc_id, 'payload.text.content' AS field, text_content AS t FROM docs UNION ALL SELECT doc_id, 'payload.image.name', image_name FROM docs
    UNION ALL SELECT doc_id, 'payload.image.caption', image_caption FROM docs UNION ALL SELECT doc_id, 'payload.file.name', file_name FROM docs
    UNION ALL SELECT doc_id, 'payload.file.caption', file_caption FROM docs UNION ALL SELECT doc_id, 'payload.richText.searchText', rich_text FROM docs
    UNION ALL SELECT CAST(num AS VARCHAR), 'payload.mergeForward.msgs.searchText', array_to_string(list_transform(items, lambda m: m.txt), ' ') FROM d2 WHERE items_n > 0
    UNION ALL SELECT message_id, 'payload.file.content', content FROM extracted WHERE outcome = 'ok')
    SELECT token, doc_id, field, count(*) AS tf FROM (SELECT doc_id, field, unnest({_words('t')}) AS token FROM texts WHERE t <> '') GROUP BY ALL""",
)
def _(spark, sf):
    return search.inverted_index(extracted_docs(written_docs(spark, sf), spark, sf))


# ---- scalar functions over all payloads -----------------------------------------------------
_EVERY = [("width", "width"), ("second", "second"), ("size", "size"), ("type", "type")]


@query("json_integer", O.R + "SELECT id, shard_table, " + ", ".join(f"{O._int('body', n)} AS {a}" for n, a in _EVERY) + " FROM routed WHERE body IS NOT NULL")
def _(spark, sf):
    p = enrich.with_payload(rows_of(spark, sf)).select(
        "id", "shard_table", F.col("body").isNotNull().alias("ok"), *[jsonx.integer_of(F.col(f"body.{n}")).alias(a) for n, a in _EVERY]
    )
    return p.where("ok").drop("ok")


@query("json_int64", O.R + "SELECT id, shard_table, " + ", ".join(f"{O._num_or_text('body', n)} AS {a}" for n, a in _EVERY) + " FROM routed WHERE body IS NOT NULL")
def _(spark, sf):
    p = enrich.with_payload(rows_of(spark, sf)).select(
        "id", "shard_table", F.col("body").isNotNull().alias("ok"),
        *[jsonx.zero_as_null(jsonx.integer_or_text_of(F.col(f"body.{n}"))).alias(a) for n, a in _EVERY],
    )
    return p.where("ok").drop("ok")


@query("clamp_int32", O.R + f"SELECT id, shard_table, {O._size('body', 'width')} AS width, {O._size('body', 'height')} AS height FROM routed WHERE body IS NOT NULL")
def _(spark, sf):
    p = enrich.with_payload(rows_of(spark, sf)).select(
        "id", "shard_table", F.col("body").isNotNull().alias("ok"),
        *[jsonx.clamp_int32(jsonx.integer_of(F.col(f"body.{n}"))).alias(n) for n in ("width", "height")],
    )
    return p.where("ok").drop("ok")


@query("json_string", O.R + f"SELECT id, shard_table, {O._str('body', 'content')} AS content, {O._str('body', 'name')} AS name, {O._str('body', 'space_id')} AS space FROM routed WHERE body IS NOT NULL")
def _(spark, sf):
    p = enrich.with_payload(rows_of(spark, sf)).select(
        "id", "shard_table", F.col("body").isNotNull().alias("ok"), jsonx.string_of(F.col("body.content")).alias("content"),
        jsonx.string_of(F.col("body.name")).alias("name"), jsonx.string_of(F.col("body.space_id")).alias("space"),
    )
    return p.where("ok").drop("ok")


@query("epoch_seconds", "SELECT event_id, epoch_us(ts) // 1000000 AS created_unix, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day_no FROM events")
def _(spark, sf):
    ev = driver_tables.tables(spark, sf)["events"]
    unix = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return ev.select("event_id", unix.alias("created_unix"), F.floor(unix / 86400).cast("bigint").alias("day_no"))


# ---- gates -----------------------------------------------------------------------------------
@query("schema_compat", O.X + """SELECT * FROM (VALUES ('parentMessageId', TRUE, (SELECT count(parent_id) FROM docs)), ('parentPayloadType', TRUE, (SELECT count(parent_type) FROM docs)),
  ('virtual', TRUE, (SELECT count(virtual) FROM docs)), ('subSeq', TRUE, (SELECT count(sub_seq) FROM docs)), ('payload.richText.searchText', TRUE, (SELECT count(rich_text) FROM docs)),
  ('payload.file.content', TRUE, 0), ('payload.file.contentMeta.extractedAt', TRUE, 0), ('payload.file.contentMeta.status', TRUE, 0), ('payload.file.contentMeta.reason', TRUE, 0),
  ('payload.mergeForward.msgs.from', TRUE, (SELECT count(*) FROM d2 WHERE len(list_filter(items, lambda m: m.f IS NOT NULL)) > 0)),
  ('payload.mergeForward.msgs.timestamp', TRUE, (SELECT count(*) FROM d2 WHERE len(list_filter(items, lambda m: m.ts IS NOT NULL)) > 0))) t(path, declared, documents)""")
def _(spark, sf):
    docs = docs_of(spark, sf)
    gates.require_compatible(docs.schema)
    return gates.path_coverage(docs, C.REQUIRED_PATHS)


_READER = {
    "messageId": "message_id", "messageSeq": "message_seq", "channelId": "channel_id", "channelType": "channel_type", "from": "from_id", "to": "to_id",
    "spaceId": "space_id", "visibles": "visibles", "timestamp": "ts", "payload.type": "payload_type", "payload.text.content": "text_content",
    "payload.image.caption": "image_caption", "payload.image.name": "image_name", "payload.file.caption": "file_caption", "payload.file.name": "file_name",
    "payload.file.extension": "file_extension",
}
_ITEMS = {"searchText": "txt", "from": "f", "timestamp": "ts"}


@query("drift_gate", O.X + " UNION ALL ".join(
    [f"SELECT '{path}' AS path, TRUE AS declared, count({column}) AS documents FROM docs" for path, column in _READER.items()]
    + [f"SELECT 'payload.mergeForward.msgs.{n}', TRUE, count(*) FROM d2 WHERE len(list_filter(items, lambda m: m.{f} IS NOT NULL)) > 0" for n, f in _ITEMS.items()]
))
def _(spark, sf):
    docs = docs_of(spark, sf)
    gates.require_reader_fields(docs.schema)
    return gates.path_coverage(docs, C.READER_PATHS)


# ---- whole jobs -------------------------------------------------------------------------------
@query("historical_load", O.D + f"SELECT {_FLAT} FROM docs")
def _(spark, sf):
    target = historical.LoadTarget.below(spark, new_work_dir(spark, "load-job"), **SLOTS)
    historical.run(rows_of(spark, sf), target)
    return flat(target.store.read())


@query("resume_load", O.DL + "SELECT (SELECT count(*) FROM docs) AS documents, (SELECT count(DISTINCT dedup_key) FROM letters) AS letters")
def _(spark, sf):
    """A load that stops half-way and is resumed, then repeated: nothing is lost or doubled."""
    target = historical.LoadTarget.below(spark, new_work_dir(spark, "resume-job"), **SLOTS)
    rows = rows_of(spark, sf)
    historical.run(rows.where("id < 1000000000000"), target)
    historical.run(rows, target)
    historical.run(rows, historical.LoadTarget(target.store, target.dlq_root, VersionedPointer(spark, target.dlq_root + "-lost-cursors")))
    docs = target.store.read().agg(F.count(F.lit(1)).alias("documents"))
    dead = historical.letters(spark, target).agg(F.count(F.lit(1)).alias("letters"))
    return docs.unionByName(dead, allowMissingColumns=True).agg(F.max("documents").alias("documents"), F.max("letters").alias("letters"))


@query("cutover", O.D + "SELECT (SELECT count(*) FROM docs) AS documents, TRUE AS switched")
def _(spark, sf):
    root = new_work_dir(spark, "cutover-job")
    target = historical.LoadTarget.below(spark, root, **SLOTS)
    rows = rows_of(spark, sf)
    historical.run(rows, target)
    docs = target.store.read()
    alias = cutover.ReadAlias(spark, f"{root}/alias")
    # textual ids are dead-lettered, so the report is clean but for negative sequence numbers
    clean = rows.withColumn("message_seq", F.greatest("message_seq", F.lit(0)))
    done = alias.publish(target.store.root, reconcile.report(clean, docs, historical.letters(spark, target), FROM, TO), docs)
    return DocumentStore(spark, alias.current(), **SLOTS).read().agg(F.count(F.lit(1)).alias("documents")).withColumn("switched", F.lit(done))


def stream_folder(spark, sf, root):
    """All messages as stream records in files, with three poisons per shard: an old version, junk, and a list of viewers that names nobody.

    Every second record is written as another producer might: the payload first or in the middle, blanks around it, its key once more inside.
    """
    messages = enrich.contract_rows(enrich.with_route(tables.dealt(rows_of(spark, sf))), ["shard_table", "id"])
    plain = F.to_json(F.struct(*[F.col(n) for n in wire.NAMES if n != "raw_payload"]))
    rest, raw = F.substring(plain, F.lit(2), F.length(plain)), F.col("raw_payload")
    orders = [
        F.concat(F.lit('{"raw_payload":'), raw, F.lit(","), rest),
        F.concat(F.lit(' { "note" : {"raw_payload":{"type":1}}, "raw_payload" :\t'), raw, F.lit("\n , "), rest),
    ]
    pick = F.pmod(F.xxhash64("message_id"), F.lit(4))
    foreign = F.when(pick == 0, orders[0]).when(pick == 1, orders[1])
    ours = wire.encode(messages.withColumn("_foreign", foreign), "messages", keep=("_foreign",))
    keyed = ours.withColumn("value", F.coalesce(F.col("_foreign").cast("binary"), "value")).withColumn("message_id", F.col("key").cast("string"))
    spots = F.conv(F.substring(F.sha1("key"), 1, 2), 16, 10).cast("int") % 4
    records = keyed.select(
        "topic", spots.alias("partition"), F.get_json_object(F.col("value").cast("string"), "$.message_seq").cast("bigint").alias("offset"), "key", "value"
    )
    poisons = ['{"schema_version":1,"message_id":"1"}', "junk", '{"schema_version":2,"raw_payload":{"type":1,"visibles":[]},"message_id":"1","visibles":["a"]}']
    bad_values = F.explode(F.array(*map(F.lit, poisons)))
    poison = rows_of(spark, sf).groupBy("shard_table").agg(F.max("id").alias("offset")).select(
        F.lit("messages").alias("topic"), F.lit(0).alias("partition"), "offset", F.col("shard_table").cast("binary").alias("key"),
        bad_values.alias("value"),
    ).withColumn("value", F.col("value").cast("binary"))
    # written first: finding the bounds of the ranges reads all records before they are dealt out
    tables.staged(records.unionByName(poison), "stream-records").repartitionByRange("partition", "offset").write.parquet(f"{root}/stream")
    return f"{root}/stream"


@query("index_stream", O.D + f"SELECT {_FLAT} FROM docs")
def _(spark, sf):
    root = new_work_dir(spark, "index-stream")
    store = DocumentStore(spark, f"{root}/docs", **SLOTS)
    folder = stream_folder(spark, sf, root)
    indexing.start(streams.file_stream(spark, folder, max_files=2), store, f"{root}/dlq", f"{root}/progress").awaitTermination()
    docs = flat(store.read())
    return docs.select(*O.DOC_FLAT)


@query("poison_order", O.R + f"""SELECT reason, count(*) AS records FROM (SELECT '{C.INDEXER_SCHEMA}' AS reason FROM (SELECT DISTINCT shard_table FROM src), range(2)
  UNION ALL SELECT '{C.INDEXER_UNTRUSTED}' FROM (SELECT DISTINCT shard_table FROM src)
  UNION ALL SELECT '{C.INDEXER_PERMANENT}' FROM routed WHERE outcome <> 'dlq' AND NOT regexp_matches(message_id, '^[+-]?[0-9]+$')) GROUP BY ALL""")
def _(spark, sf):
    root = new_work_dir(spark, "poison")
    records = spark.read.schema(C.ddl(C.STREAM_FIELDS)).parquet(stream_folder(spark, sf, root))
    bad = enrich.only(wire.judged(records), F.col("reason").isNotNull(), "reason")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


_FILE_RESULT = O.X + """SELECT message_id AS doc_id, outcome, whole IS NOT NULL AND outcome = 'ok' AS has_content FROM (SELECT message_id, outcome, whole FROM outcomes)"""


# the stream leg takes a declared size from a number only
_STREAM_RESULT = _FILE_RESULT.replace(
    "file_size AS size FROM docs WHERE payload_type = 8",
    f"s.size AS size FROM docs LEFT JOIN (SELECT message_id AS mid, {O._int('body', 'size')} AS size FROM routed) s ON s.mid = doc_id WHERE payload_type = 8",
)


def file_results(store, leg):
    """Outcome of every file message, and the records that were none."""
    dead = leg.letters().select(F.col("messageId").alias("doc_id"), "reason")
    docs = store.read().where("payload.type = 8").select(F.col("_id").alias("doc_id"), F.col("payload.file.content").isNotNull().alias("has_content"))
    # neither text nor letter: the format waits for a plug-in
    open_ = F.when(F.col("has_content"), F.lit("ok")).otherwise(F.lit(files.NO_EXTRACTOR))
    rows = docs.join(dead, "doc_id", "left").select("doc_id", F.coalesce("reason", open_).alias("outcome"), "has_content")
    junk = dead.where(F.col("reason") == C.FILE_PARSE).select("doc_id", F.col("reason").alias("outcome"), F.lit(None).cast("boolean").alias("has_content"))
    return rows.unionByName(junk)


_STREAM_LETTERS = _STREAM_RESULT + f""" UNION ALL SELECT shard_table, '{C.FILE_PARSE}', NULL FROM (SELECT DISTINCT shard_table FROM src)"""


@query("file_stream", _STREAM_LETTERS)
def _(spark, sf):
    """The index leg first, then the file leg over the same stream."""
    root = new_work_dir(spark, "file-stream")
    store = DocumentStore(spark, f"{root}/docs", **SLOTS)
    folder = stream_folder(spark, sf, root)
    indexing.start(streams.file_stream(spark, folder), store, f"{root}/dlq", f"{root}/progress").awaitTermination()
    leg = extraction.FileLeg(store, driver_tables.file_bytes(spark, sf), O.HOSTS, f"{root}/files")
    extraction.start(streams.file_stream(spark, folder, max_files=4), leg, f"{root}/file-progress", lambda: NOW).awaitTermination()
    return file_results(store, leg)


@query("file_retries", _STREAM_LETTERS)
def _(spark, sf):
    """The file leg starts before there is any document, is stopped, and goes on from its checkpoint when there are."""
    root = new_work_dir(spark, "file-retries")
    store = DocumentStore(spark, f"{root}/docs", **SLOTS)
    folder = stream_folder(spark, sf, root)
    leg = extraction.FileLeg(store, driver_tables.file_bytes(spark, sf), O.HOSTS, f"{root}/files")
    go = lambda: retries.start(streams.file_stream(spark, folder, max_files=4), leg, f"{root}/file-progress", base=2.0, cap=10.0, now_unix=lambda: NOW)
    early = go()
    while not early.recentProgress and not early.awaitTermination(1):
        pass
    early.stop()
    indexing.start(streams.file_stream(spark, folder), store, f"{root}/dlq", f"{root}/progress").awaitTermination()
    if not retries.run_until_drained(go()):
        raise TimeoutError("texts still wait")
    return file_results(store, leg)


@query("file_backfill", _FILE_RESULT)
def _(spark, sf):
    root = new_work_dir(spark, "file-backfill")
    target = historical.LoadTarget.below(spark, root, **SLOTS)
    historical.run(rows_of(spark, sf), target)
    out = file_backfill.run(target.store, driver_tables.file_bytes(spark, sf), O.HOSTS, NOW, f"{root}/file-dlq", "1")
    docs = target.store.read().select(F.col("_id").alias("doc_id"), F.col("payload.file.content").isNotNull().alias("has_content"))
    return out.select(F.col("message_id").alias("doc_id"), "outcome").join(docs, "doc_id")
