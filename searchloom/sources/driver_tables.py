"""Message shards derived from the given tables.

The tables hold no message shards, so events, conversations, pages and documents are
mapped to shard rows by plain SQL that means the same in Spark and in other engines:
only concatenation, CASE and casts. Every row of the four tables becomes one message
and every text is carried whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["events", "conversations", "pages", "documents"]
BASE_ID = 3000000000000000000
FILE_HOST = "files.example.com"


def _escaped(expr: str) -> str:
    """SQL that escapes a text for use inside a JSON string."""
    steps = [("chr(92)", "concat(chr(92), chr(92))"), ("chr(34)", "concat(chr(92), chr(34))")]
    steps += [(f"chr({c})", f"concat(chr(92), '{e}')") for c, e in [(10, "n"), (13, "r"), (9, "t")]]
    for find, put in steps:
        expr = f"replace({expr}, {find}, {put})"
    return expr


def _event_payload() -> str:
    n = "CAST(event_id AS STRING)"
    kinds = [
        # text, alone and with a space and an access list
        f"""concat('{{"type":1,"content":"', event_type, ' note ', {n}, '","meta":', props, '}}')""",
        f"""concat('{{"type":1,"content":"', event_type, ' for ', {n}, '","space_id":"s', CAST(user_id % 9 AS STRING), '","visibles":["u', CAST(user_id AS STRING), '","admin"]}}')""",
        # images: usual sizes, sizes beyond 32 bits
        f"""concat('{{"type":2,"url":"https://img.example.com/', {n}, '.png","name":"photo ', {n}, '.png","caption":"', event_type, ' picture","width":800,"height":600}}')""",
        f"""concat('{{"type":2,"url":"https://img.example.com/', {n}, '.jpg","name":"","width":4294967296,"height":-5}}')""",
        f"""concat('{{"type":3,"url":"https://img.example.com/', {n}, '.gif"}}')""",
        f"""concat('{{"type":4,"url":"https://voice.example.com/', {n}, '.mp3","second":9}}')""",
        f"""concat('{{"type":5,"url":"https://video.example.com/', {n}, '","cover":"https://img.example.com/c', {n}, '.jpg","width":1920,"height":1080,"second":', CAST(event_id % 600 AS STRING), '}}')""",
        # files: size as text, videos sent as files by name and by extension
        f"""concat('{{"type":8,"url":"https://{FILE_HOST}/pdf/', {n}, '.pdf","name":"paper ', {n}, '.PDF","caption":"', event_type, ' paper","size":"', {n}, '","extension":"pdf"}}')""",
        f"""concat('{{"type":8,"url":"https://{FILE_HOST}/clip/', {n}, '","name":"clip ', {n}, '.MP4","size":77,"extension":"bin"}}')""",
        f"""concat('{{"type":8,"url":"https://{FILE_HOST}/clip/', {n}, '","name":".mkv","size":1.5,"extension":"MKV"}}')""",
        # forwarded bundles
        f"""concat('{{"type":11,"msgs":[{{"message_id":"9007199254740993","from_uid":"u', CAST(user_id AS STRING), '","timestamp":1700000123,"payload":{{"type":1,"content":"inner ', event_type, '"}}}},{{"message_id":', {n}, ',"from_uid":5,"payload":{{"type":8,"name":"inner ', {n}, '.doc","caption":"kept"}}}},7,{{"payload":"none"}}]}}')""",
        """concat('{"type":11,"msgs":[1,"two",null]}', '')""",
        # rich text: blocks, plain text given, content as a string
        f"""concat('{{"type":14,"content":[{{"type":"text","text":"rich ', event_type, ' "}},{{"type":"image","url":"https://img.example.com/a', {n}, '.png","name":"first ', {n}, '","width":640,"height":480}},5,{{"type":"file","name":"sheet.xls","url":"https://{FILE_HOST}/x"}},{{"type":"image","url":"https://img.example.com/b', {n}, '.png","caption":"second","width":70000000000}}]}}')""",
        f"""concat('{{"type":14,"content":"string body ', {n}, '"}}')""",
        f"""concat('{{"type":14,"plain":"given plain ', {n}, '","content":[{{"type":"image","url":"","name":"no address"}},{{"type":"image","url":"https://img.example.com/p', {n}, '.png"}},{{"type":"other","text":"odd"}}]}}')""",
        # unknown type with an access list, then lists that must not be trusted
        f"""concat('{{"type":99,"note":"system ', {n}, '","visibles":["u_admin","u', CAST(user_id AS STRING), '"]}}')""",
        """concat('{"type":99,"visibles":[]}', '')""",
        """concat('{"type":1,"content":"hidden","visibles":null}', '')""",
        """concat('{"type":99,"visibles":[1,2]}', '')""",
        """concat('{"type":1,"content":"hidden","visibles":["",""]}', '')""",
        """concat('{"type":1,"content":"hidden","visibles":"u1,u2"}', '')""",
        f"""concat('{{"type":1,"content":"odd space ', {n}, '","space_id":12345,"visibles":["z","a","z"]}}')""",
        # payloads that are not one non-empty object
        """concat('{not valid json', '')""",
        """concat('{}', '')""",
        f"""concat('["', event_type, '"]')""",
        f"""concat('ciphertext-', {n})""",
        f"""concat('ciphertext-', {n})""",
        # numbers that route as text but project to nothing, and odd contents
        f"""concat('{{"type":1.5,"content":"fraction ', {n}, '"}}')""",
        """concat('{"type":1,"content":{"k":"v"}}', '')""",
        f"""concat('{{"content":"no type ', {n}, '"}}')""",
        """concat('{"type":"1","content":"type as text"}', '')""",
        f"""concat('{{"type":1,"content":"tail ', {n}, '"}} tail')""",
        f"""concat('{{"type":11,"msgs":[{{"message_id":"x1","timestamp":"1700000456","payload":{{"type":14,"content":[{{"type":"text","text":"deep ', event_type, '"}},{{"type":"image","name":"deep.png"}},{{"type":"file"}}]}}}}]}}')""",
        f"""concat('{{"type":1,"content":"会议改期 ', event_type, ' 会议 ', {n}, '"}}')""",
        """concat('null', '')""",
        f"""concat('{{"type":2.0,"url":"https://img.example.com/', {n}, '.png"}}')""",
        f"""concat('{{"type":1,"content":"mixed list ', {n}, '","visibles":["a",1,null,"","b"]}}')""",
    ]
    whens = "\n".join(f"      WHEN {i} THEN {k}" for i, k in enumerate(kinds))
    return f"CASE event_id % {len(kinds)}\n{whens}\n    END", len(kinds)


def shard_rows_sql(dialect: str) -> str:
    """SELECT that turns the four tables into shard rows, payload as text."""
    epoch = {
        "spark": "unix_timestamp(CAST(ts AS TIMESTAMP))",
        "duckdb": "(epoch_us(ts) // 1000000)",
    }[dialect]
    n_bytes = {"spark": "octet_length({0})", "duckdb": "strlen({0})"}[dialect]
    payload, kinds = _event_payload()
    shard = "CASE WHEN {0} % 5 = 0 THEN 'message' ELSE concat('message', CAST({0} % 5 AS STRING)) END"
    files = f"https://{FILE_HOST}"
    page_url = f"CASE WHEN page_id % 5 = 0 THEN url ELSE concat('{files}/pages/', CAST(page_id AS STRING), '.html') END"
    doc_id = "CAST(doc_id AS STRING)"
    doc_name = f"""CASE doc_id % 11 WHEN 0 THEN concat('report-', {doc_id}, '.md') WHEN 1 THEN concat('bundle-', {doc_id}, '.zip')
      WHEN 2 THEN concat('clip-', {doc_id}, '.mp4') WHEN 3 THEN concat('notes ', {doc_id}) ELSE concat('text-', {doc_id}, '.txt') END"""
    doc_ext = "CASE doc_id % 11 WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN ' TXT ' WHEN 4 THEN 'pdf' ELSE 'txt' END"
    doc_url = f"""CASE doc_id % 13 WHEN 0 THEN concat('http://{FILE_HOST}/docs/', {doc_id}) WHEN 1 THEN concat('https://elsewhere.example.com/docs/', {doc_id})
      WHEN 2 THEN '' WHEN 3 THEN concat('{files}/gone/', {doc_id}) WHEN 4 THEN concat('https://FILES.example.com:8443/docs/', {doc_id})
      ELSE concat('{files}/docs/', {doc_id}) END"""
    doc_size = f"CASE WHEN doc_id % 17 = 5 THEN 31457280 ELSE {n_bytes.format('text')} END"
    return f"""
  SELECT {shard.format('event_id')} AS shard_table,
    1000000000000 + event_id AS id,
    CASE WHEN event_id % 97 = 13 THEN concat('m-', CAST(event_id AS STRING))
      ELSE CAST({BASE_ID} + event_id * 1000 AS STRING) END AS message_id,
    CASE WHEN event_id % 89 = 5 THEN -7 ELSE event_id END AS message_seq,
    concat('u', CAST(user_id AS STRING)) AS from_uid,
    CASE event_id % 6 WHEN 0 THEN concat('u', CAST(user_id AS STRING), '@v', CAST(event_id % 50 AS STRING))
      WHEN 1 THEN concat('a', CAST(event_id % 50 AS STRING), '@u', CAST(user_id AS STRING))
      WHEN 2 THEN 'left@mid@right' WHEN 3 THEN 'left@right' ELSE concat('g', CAST(user_id % 20 AS STRING)) END AS channel_id,
    CASE WHEN event_id % 6 < 4 THEN 1 ELSE 2 END AS channel_type,
    CASE WHEN event_id % {kinds} = 26 THEN 33 ELSE 1 END AS setting,
    CASE WHEN event_id % {kinds} = 25 THEN 1 ELSE 0 END AS signal,
    {epoch} - event_id % 7 AS timestamp,
    {epoch} AS created_unix,
    {payload} AS payload
  FROM events
  UNION ALL
  SELECT {shard.format('conv_id')}, conv_id * 1000 + turn + 1, CAST({BASE_ID} + 100000000000000000 + conv_id * 1000 + turn AS STRING),
    turn, role, concat('c', CAST(conv_id AS STRING)), 2, 0, 0,
    1704067200 + conv_id * 7 + turn, 1704067200 + conv_id * 7 + turn,
    concat('{{"type":1,"content":"', {_escaped('text')}, '"}}')
  FROM conversations
  UNION ALL
  SELECT {shard.format('page_id')}, 100000000000 + page_id, CAST({BASE_ID} + 200000000000000000 + page_id * 1000 AS STRING),
    page_id, 'crawler', 'pages', 2, 0, 0, 1704067200 + page_id, 1704067201 + page_id,
    concat('{{"type":8,"url":"', {page_url}, '","name":"page-', CAST(page_id AS STRING), '.html","size":', CAST({n_bytes.format('html')} AS STRING), ',"extension":"html"}}')
  FROM pages
  UNION ALL
  SELECT {shard.format('doc_id')}, 200000000000 + doc_id, CAST({BASE_ID} + 300000000000000000 + doc_id * 1000 AS STRING),
    doc_id, source, concat('docs-', lang), 2, 0, 0, 1704067200 + doc_id, 1704067203 + doc_id,
    concat('{{"type":8,"url":"', {doc_url}, '","name":"', {doc_name}, '","caption":"', source, ' ', lang, '","size":"', CAST({doc_size} AS STRING), '","extension":"', {doc_ext}, '"}}')
  FROM documents"""


def file_bytes_sql() -> str:
    """SELECT of stored files: address and whole text."""
    files = f"https://{FILE_HOST}"
    return f"""
  SELECT concat('{files}/pages/', CAST(page_id AS STRING), '.html') AS url, html AS body FROM pages
  UNION ALL
  SELECT concat('{files}/docs/', CAST(doc_id AS STRING)), text FROM documents
  UNION ALL
  SELECT concat('https://FILES.example.com:8443/docs/', CAST(doc_id AS STRING)), concat(' ', chr(10), ' ')
  FROM documents WHERE doc_id % 13 = 4"""


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shards as rows of ``contract.ROW_SCHEMA``."""
    sql = _placed(shard_rows_sql("spark"))
    rows = spark.sql(sql, **tables(spark, sf_dir))
    return rows.selectExpr(
        "shard_table", "id", "message_id", "message_seq", "from_uid", "channel_id", "channel_type",
        "setting", "signal", "timestamp", "created_unix", "CAST(payload AS BINARY) AS payload",
    )


def file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files: url, body as bytes."""
    rows = spark.sql(_placed(file_bytes_sql()), **tables(spark, sf_dir))
    return rows.selectExpr("url", "CAST(body AS BINARY) AS body")


def _placed(sql: str) -> str:
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in TABLES:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return sql
