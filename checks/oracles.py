"""The registered queries once more, as plain SQL for an independent engine.

The SQL works on JSON functions, list functions and joins only and shares nothing with
the library but the derivation of shard rows from the given tables.
"""

from __future__ import annotations

from searchloom import contract as C
from searchloom.functions.textx import HTML_ENTITIES
from searchloom.sources.driver_tables import file_bytes_sql, shard_rows_sql

FROM_UNIX = 1704067200
TO_UNIX = FROM_UNIX + 20 * 86400
MID_UNIX = FROM_UNIX + 10 * 86400
NOW_UNIX = FROM_UNIX + 25 * 86400
LAG = 600
MAX_CONTENT = 4096
SMALL_MESSAGE = 420
SMALL_ENVELOPE = 330
SMALL_DLQ = 60
SMALL_DOC = 600
HOSTS = ["files.example.com"]
INTS = "('UBIGINT', 'BIGINT')"


# ---- JSON readers -------------------------------------------------------------
def _str(j: str, name: str) -> str:
    return f"CASE WHEN json_type({j}, '$.{name}') = 'VARCHAR' THEN json_extract_string({j}, '$.{name}') END"


def _txt(j: str, name: str) -> str:
    return f"nullif({_str(j, name)}, '')"


def _int(j: str, name: str) -> str:
    return f"CASE WHEN json_type({j}, '$.{name}') IN {INTS} THEN TRY_CAST(json_extract_string({j}, '$.{name}') AS BIGINT) END"


def _size(j: str, name: str) -> str:
    return f"CASE WHEN {_int(j, name)} BETWEEN 1 AND 2147483647 THEN {_int(j, name)} END"


def _num_or_text(j: str, name: str) -> str:
    text = f"json_extract_string({j}, '$.{name}')"
    return (
        f"nullif(CASE WHEN json_type({j}, '$.{name}') IN {INTS} OR (json_type({j}, '$.{name}') = 'VARCHAR' "
        f"AND regexp_matches({text}, '^[+-]?[0-9]+$')) THEN TRY_CAST({text} AS BIGINT) END, 0)"
    )


def _objects(j: str, name: str) -> str:
    arr = f"CASE WHEN json_type({j}, '$.{name}') = 'ARRAY' THEN CAST(json_extract({j}, '$.{name}') AS JSON[]) END"
    return f"list_filter({arr}, lambda o: json_type(o) = 'OBJECT')"


def _blocks(j: str) -> str:
    block = f"""struct_pack(t := {_str('b', 'type')}, txt := {_txt('b', 'text')}, nm := {_txt('b', 'name')},
      cap := {_txt('b', 'caption')}, url := {_txt('b', 'url')}, w := {_size('b', 'width')}, h := {_size('b', 'height')})"""
    return f"""CASE WHEN json_type({j}, '$.content') = 'ARRAY' THEN list_transform({_objects(j, 'content')}, lambda b: {block})
      WHEN {_txt(j, 'content')} IS NOT NULL THEN [struct_pack(t := 'text', txt := {_txt(j, 'content')}, nm := CAST(NULL AS VARCHAR),
        cap := CAST(NULL AS VARCHAR), url := CAST(NULL AS VARCHAR), w := CAST(NULL AS BIGINT), h := CAST(NULL AS BIGINT))] END"""


def _plain(blocks: str) -> str:
    return f"""array_to_string(list_transform({blocks}, lambda k: CASE k.t WHEN 'image' THEN '{C.IMAGE_MARK}'
      WHEN 'file' THEN concat_ws(' ', '{C.FILE_MARK}', k.nm) ELSE coalesce(k.txt, '') END), '')"""


def _rich(j: str, blocks: str) -> str:
    given = _str(j, "plain")
    plain = f"CASE WHEN {given} IS NOT NULL AND NOT regexp_matches({given}, '^[\\s\\p{{Z}}]*$') THEN {given} ELSE {_plain(blocks)} END"
    labels = f"flatten(list_transform(list_filter({blocks}, lambda k: k.t IN ('image', 'file')), lambda k: [k.nm, k.cap]))"
    return f"""nullif(array_to_string(list_filter(list_concat([{plain}], coalesce({labels}, [])), lambda x: x IS NOT NULL AND x <> ''), ' '), '')"""


def _search_text(j: str, kind: str) -> str:
    return f"""CASE {kind} WHEN 1 THEN {_txt(j, 'content')}
      WHEN 2 THEN nullif(concat_ws(' ', {_txt(j, 'caption')}, {_txt(j, 'name')}), '')
      WHEN 8 THEN nullif(concat_ws(' ', {_txt(j, 'name')}, {_txt(j, 'caption')}), '')
      WHEN 14 THEN {_rich(j, f'({_blocks(j)})')} END"""


def _name_first_ext(name: str, ext: str) -> str:
    return f"lower(coalesce(nullif(regexp_extract(coalesce({name}, ''), '(?s)^.+\\.([^.]+)$', 1), ''), {ext}, ''))"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ---- shared steps ---------------------------------------------------------------
SRC = "src AS (" + shard_rows_sql("duckdb") + ")"
ROUTED = f"""
q0 AS (SELECT *, (signal <> 0 OR (setting & 32) <> 0) AS encrypted, CASE WHEN json_valid(payload) THEN payload END AS js FROM src),
q1 AS (SELECT *, CASE WHEN json_type(js) = 'OBJECT' AND len(json_keys(js)) > 0 THEN js END AS body FROM q0),
q2 AS (SELECT *, json_type(body, '$.visibles') AS vis_type,
  CASE WHEN json_type(body, '$.visibles') = 'ARRAY' THEN list_filter(list_transform(list_filter(CAST(json_extract(body, '$.visibles') AS JSON[]),
    lambda x: json_type(x) = 'VARCHAR'), lambda x: json_extract_string(x, '$')), lambda s: s <> '') END AS names FROM q1),
q3 AS (SELECT *, CASE WHEN encrypted THEN NULL WHEN body IS NULL THEN '{C.PRODUCER_UNPARSEABLE}'
    WHEN vis_type IS NOT NULL AND coalesce(len(names), 0) = 0 THEN '{C.PRODUCER_UNTRUSTED}' END AS reason,
  CASE WHEN NOT encrypted AND json_type(body, '$.type') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
    THEN CAST(trunc(CAST(json_extract_string(body, '$.type') AS DOUBLE)) AS BIGINT) ELSE 0 END AS content_type FROM q2),
q4 AS (SELECT *, CASE WHEN NOT encrypted AND reason IS NULL AND content_type = 1 THEN {_str('body', 'content')} END AS content FROM q3),
routed AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'dlq' WHEN content IS NULL THEN 'raw_excluded' ELSE 'ok' END AS outcome,
  CASE WHEN NOT encrypted THEN {_txt('body', 'space_id')} END AS space_id,
  CASE WHEN NOT encrypted AND reason IS NULL AND vis_type IS NOT NULL THEN names END AS visibles,
  greatest(message_seq, 0) AS seq FROM q4)"""

DOC_FLAT = [
    "doc_id", "schema_version", "message_id", "message_seq", "from_id", "to_id", "channel_id", "channel_type",
    "space_id", "visibles", "ts", "created_at", "raw_excluded", "source", "payload_type", "text_content",
    "image_url", "image_caption", "image_name", "image_width", "image_height", "gif_url", "voice_url",
    "video_url", "video_cover", "video_width", "video_height", "video_second", "file_url", "file_name",
    "file_caption", "file_size", "file_extension", "merge_count", "merge_text", "rich_text",
    "payload_raw", "parent_id", "parent_type", "virtual", "sub_seq",
]

_PARENT = {
    "doc_id": "CAST(num AS VARCHAR)",
    "schema_version": "2",
    "message_id": "num",
    "message_seq": "nullif(seq, 0)",
    "from_id": "nullif(from_uid, '')",
    "to_id": """CASE WHEN NOT encrypted AND channel_type = 1 AND len(string_split(channel_id, '@')) = 2 THEN nullif(
      CASE WHEN from_uid = string_split(channel_id, '@')[1] THEN string_split(channel_id, '@')[2] ELSE string_split(channel_id, '@')[1] END, '') END""",
    "channel_id": "channel_id",
    "channel_type": "channel_type",
    "space_id": "space_id",
    "visibles": "array_to_string(visibles, '|')",
    "ts": "timestamp",
    "created_at": "nullif(created_unix, 0)",
    "raw_excluded": "CASE WHEN encrypted OR NOT coalesce(kind IN (1, 2, 3, 4, 5, 8) OR items_n > 0 OR rich IS NOT NULL, FALSE) THEN TRUE END",
    "source": f"'{C.SOURCE_TAG}'",
    "payload_type": "CASE WHEN video THEN 5 ELSE kind END",
    "text_content": f"CASE WHEN kind = 1 THEN {_txt('body', 'content')} END",
    "image_url": f"CASE WHEN kind = 2 THEN {_txt('body', 'url')} END",
    "image_caption": f"CASE WHEN kind = 2 THEN {_txt('body', 'caption')} END",
    "image_name": f"CASE WHEN kind = 2 THEN {_txt('body', 'name')} END",
    "image_width": f"CASE WHEN kind = 2 THEN {_size('body', 'width')} END",
    "image_height": f"CASE WHEN kind = 2 THEN {_size('body', 'height')} END",
    "gif_url": f"CASE WHEN kind = 3 THEN {_txt('body', 'url')} END",
    "voice_url": f"CASE WHEN kind = 4 THEN {_txt('body', 'url')} END",
    "video_url": f"CASE WHEN kind = 5 OR video THEN {_txt('body', 'url')} END",
    "video_cover": f"CASE WHEN kind = 5 THEN {_txt('body', 'cover')} END",
    "video_width": f"CASE WHEN kind = 5 THEN {_size('body', 'width')} END",
    "video_height": f"CASE WHEN kind = 5 THEN {_size('body', 'height')} END",
    "video_second": f"CASE WHEN kind = 5 THEN {_size('body', 'second')} END",
    "file_url": f"CASE WHEN kind = 8 AND NOT video THEN {_txt('body', 'url')} END",
    "file_name": f"CASE WHEN kind = 8 AND NOT video THEN {_txt('body', 'name')} END",
    "file_caption": f"CASE WHEN kind = 8 AND NOT video THEN {_txt('body', 'caption')} END",
    "file_size": f"CASE WHEN kind = 8 AND NOT video THEN {_num_or_text('body', 'size')} END",
    "file_extension": f"CASE WHEN kind = 8 AND NOT video THEN {_txt('body', 'extension')} END",
    "merge_count": "nullif(items_n, 0)",
    "merge_text": "CASE WHEN items_n > 0 THEN array_to_string(list_transform(items, lambda m: concat_ws('~', coalesce(CAST(m.id AS VARCHAR), '-'), coalesce(CAST(m.t AS VARCHAR), '-'), coalesce(m.txt, '-'), coalesce(m.f, '-'), coalesce(CAST(m.ts AS VARCHAR), '-'))), ';') END",
    "rich_text": "rich",
    "payload_raw": "CASE WHEN NOT encrypted THEN payload END",
    "parent_id": "CAST(NULL AS BIGINT)",
    "parent_type": "CAST(NULL AS INTEGER)",
    "virtual": "CAST(NULL AS BOOLEAN)",
    "sub_seq": "0",
}
_CHILD = {
    **{n: "NULL" for n in DOC_FLAT},
    **{n: n for n in ["schema_version", "message_id", "message_seq", "from_id", "to_id", "channel_id", "channel_type", "space_id", "visibles", "ts", "created_at", "source"]},
    "doc_id": "concat(doc_id, '-rt', CAST(pos - 1 AS VARCHAR))",
    "payload_type": "2",
    "image_url": "b.url",
    "image_name": "b.nm",
    "image_width": "b.w",
    "image_height": "b.h",
    "parent_id": "message_id",
    "parent_type": "14",
    "virtual": "TRUE",
    "sub_seq": "CAST(pos AS INTEGER)",
}
_INNER = "json_extract(m, '$.payload')"
_INNER_OBJ = f"CASE WHEN json_type({_INNER}) = 'OBJECT' THEN {_INNER} END"
DOCS = f"""
d0 AS (SELECT *, CASE WHEN regexp_matches(message_id, '^[+-]?[0-9]+$') THEN TRY_CAST(message_id AS BIGINT) END AS num,
  CASE WHEN NOT encrypted THEN {_int('body', 'type')} END AS kind FROM routed WHERE outcome <> 'dlq'),
d1 AS (SELECT *, coalesce(kind = 8 AND {_name_first_ext(_str('body', 'name'), _str('body', 'extension'))} IN {_in(C.VIDEO_EXTENSIONS)}, FALSE) AS video,
  CASE WHEN kind = 14 THEN {_blocks('body')} END AS blocks,
  CASE WHEN kind = 11 THEN list_transform({_objects('body', 'msgs')}, lambda m: struct_pack(id := {_num_or_text('m', 'message_id')},
    t := nullif({_int(_INNER_OBJ, 'type')}, 0), txt := {_search_text(f'({_INNER_OBJ})', _int(_INNER_OBJ, 'type'))},
    f := {_txt('m', 'from_uid')}, ts := {_num_or_text('m', 'timestamp')})) END AS items FROM d0 WHERE num IS NOT NULL),
d2 AS (SELECT *, coalesce(len(items), 0) AS items_n, CASE WHEN kind = 14 THEN {_rich('body', 'blocks')} END AS rich FROM d1),
parents AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _PARENT.items())}, blocks, shard_table, id FROM d2),
children AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _CHILD.items())}
  FROM (SELECT p.*, unnest(blocks) AS b, unnest(range(1, len(blocks) + 1)) AS pos FROM parents p)
  WHERE b.t = 'image' AND b.url IS NOT NULL),
docs AS (SELECT {', '.join(DOC_FLAT)} FROM parents UNION ALL SELECT {', '.join(DOC_FLAT)} FROM children)"""

LETTERS = f"""
letters AS (SELECT shard_table AS tbl, id, message_id, payload, created_unix AS created_at,
  CASE WHEN reason = '{C.PRODUCER_UNPARSEABLE}' THEN '{C.LOAD_PARSE}' ELSE '{C.LOAD_CONVERT}' END AS reason,
  coalesce(nullif(message_id, ''), concat(shard_table, ':', CAST(id AS VARCHAR))) AS dedup_key
  FROM routed WHERE reason IS NOT NULL OR NOT coalesce(regexp_matches(message_id, '^[+-]?[0-9]+$'), FALSE))"""


def _html_text(col: str) -> str:
    t = f"regexp_replace({col}, '<!--.*?-->', ' ', 'gs')"
    for tag in ("script", "style", "noscript", "head"):
        t = f"regexp_replace({t}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)<(br|hr|/p|/div|/li|/ul|/ol|/tr|/table|/h[1-6]|/section|/article|/nav|/header|/footer|/blockquote|/pre)\\b[^>]*>', chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    for name, char in HTML_ENTITIES:
        t = f"replace({t}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    t = f"regexp_replace({t}, '[ \\t\\r\\x{{A0}}]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({t}, concat(' ', chr(10)))"


def _cut(col: str, n: int) -> str:
    cuts = ", ".join(f"try(decode(encode({col})[1:{n - k}]))" for k in range(4))
    return f"CASE WHEN strlen({col}) <= {n} THEN {col} ELSE coalesce({cuts}) END"


_EXT = r"""CASE WHEN regexp_replace(coalesce(extension, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') <> '' THEN lower(regexp_replace(extension, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'))
  ELSE lower(regexp_extract(coalesce(name, ''), '(\.[^./]*)$', 1)) END"""


def _dotted(e: str) -> str:
    return f"CASE WHEN {e} = '' OR starts_with({e}, '.') THEN {e} ELSE concat('.', {e}) END"


def _mime(e: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.MIME_TYPES.items())
    return f"CASE {e} {whens} ELSE '{C.DEFAULT_MIME}' END"


_AUTH = "regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')"
_HOST = f"lower(regexp_replace({_AUTH}, ':[0-9]*$', ''))"
_SCHEME = "lower(regexp_extract(coalesce(url, ''), '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
_URL_OK = f"({_SCHEME} IN ('https') AND {_HOST} IN {_in(HOSTS)} AND regexp_matches({_AUTH}, '^[^:\\[\\] ]*(:[0-9]*)?$'))"
PLAIN = _in(["text/plain", "text/csv", "text/markdown", "application/json", "application/xml", "application/x-yaml"])

OUTCOMES = f"""
f0 AS (SELECT doc_id AS message_id, file_url AS url, file_name AS name, file_extension AS extension, file_size AS size FROM docs WHERE payload_type = 8),
f1 AS (SELECT *, {_dotted(_EXT)} AS ext FROM f0),
f2 AS (SELECT *, CASE WHEN ext IN {_in(C.SKIPPED_EXTENSIONS)} THEN 'blacklist_ext' WHEN size > {C.MAX_FILE_BYTES} THEN 'oversize'
  WHEN NOT {_URL_OK} THEN 'invalid_url' END AS refused, {_mime('ext')} AS mime FROM f1),
store AS ({file_bytes_sql()}),
f3 AS (SELECT f2.*, store.body, CASE WHEN mime = 'text/html' THEN {_html_text('store.body')} WHEN mime IN {PLAIN} THEN store.body END AS whole
  FROM f2 LEFT JOIN store ON f2.url = store.url AND f2.refused IS NULL),
outcomes AS (SELECT message_id, url, ext, size, CASE WHEN refused IS NOT NULL THEN refused WHEN body IS NULL THEN 'download_failed'
   WHEN whole IS NULL THEN 'no_extractor' WHEN regexp_matches({_cut('whole', MAX_CONTENT)}, '^[\\s\\p{{Z}}]*$') THEN 'empty_extract' ELSE 'ok' END AS outcome, whole FROM f3),
extracted AS (SELECT message_id, url, ext, size, outcome, CASE WHEN outcome = 'ok' THEN {_cut('whole', MAX_CONTENT)} END AS content,
   CASE WHEN outcome = 'ok' THEN strlen(whole) > {MAX_CONTENT} END AS truncated FROM outcomes)"""


def _with(*steps: str) -> str:
    return "WITH " + ",".join(steps) + " "


R = _with(SRC, ROUTED)
D = _with(SRC, ROUTED, DOCS)
L = _with(SRC, ROUTED, LETTERS)
DL = _with(SRC, ROUTED, DOCS, LETTERS)
X = _with(SRC, ROUTED, DOCS, OUTCOMES)
