"""Fixed values and schemas shared by all legs."""

from __future__ import annotations

# ---- fixed values: wire and index contract -------------------------------
CONTRACT_VERSION = 2
DLQ_VERSION = 1
SHARDS = ["message", "message1", "message2", "message3", "message4"]
SIGNAL_BIT = 32
PERSON_CHANNEL = 1

TYPE_TEXT = 1
TYPE_IMAGE = 2
TYPE_GIF = 3
TYPE_VOICE = 4
TYPE_VIDEO = 5
TYPE_FILE = 8
TYPE_MERGE = 11
TYPE_RICH = 14

IMAGE_MARK = "[图片]"
FILE_MARK = "[文件]"

# ---- our own default ---------------------------------------------------------
# what messages name as their source; unknown in the contract, so a job may set another
SOURCE_TAG = "etl_message_table"

# ---- fixed values: size limits (bytes) -----------------------------------
MAX_MESSAGE_BYTES = 1_000_000
MAX_DLQ_PAYLOAD_BYTES = 700_000
MAX_DOC_BYTES = 50 << 20
MAX_FILE_BYTES = 20 * 1024 * 1024
MAX_CONTENT_BYTES = 262_144

# ---- fixed values: dead-letter reasons -----------------------------------
PRODUCER_UNPARSEABLE = "producer_payload_unparseable"
PRODUCER_UNTRUSTED = "producer_visibility_untrusted"
PRODUCER_OVERSIZE = "producer_oversize_truncated"
INDEXER_SCHEMA = "unknown_schema_version"
INDEXER_UNTRUSTED = "visibility_untrusted"
INDEXER_PERMANENT = "permanent_4xx"
LOAD_PARSE = "payload_parse"
LOAD_CONVERT = "doc_convert"
LOAD_REJECT = "permanent_es_reject"
LOAD_DEFAULT = "backfill_payload_unparseable"
FILE_PARSE = "parse_error"
FILE_RETRY = "retry_exhausted"
FILE_OS = "os_permanent"
PAYLOAD_DROPPED_NOTE = (
    "payload_truncated:true (oversize; replay must re-fetch from source by shard_table+source_id)"
)

# reasons that will never change for the same file: they leave a tombstone
TOMBSTONE_REASONS = [
    "blacklist_ext",
    "oversize",
    "encrypted",
    "empty_extract",
    "extract_error",
    "invalid_url",
]
TOMBSTONE_STATUS = "unextractable"

# ---- fixed values: file handling -----------------------------------------
VIDEO_EXTENSIONS = ["mp4", "avi", "mov", "mkv", "m4v", "flv", "wmv", "webm", "3gp", "ts"]
SKIPPED_EXTENSIONS = [
    ".mp4", ".mov", ".avi", ".mkv", ".webm", ".flv", ".wmv", ".m4v",
    ".mp3", ".wav", ".aac", ".flac", ".ogg", ".wma", ".m4a", ".amr",
    ".zip", ".rar", ".7z", ".tar", ".gz", ".bz2", ".xz",
    ".dmg", ".pkg", ".deb", ".rpm", ".appimage",
    ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".ico",
]
MIME_TYPES = {
    ".pdf": "application/pdf",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".ppt": "application/vnd.ms-powerpoint",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".txt": "text/plain",
    ".csv": "text/csv",
    ".rtf": "application/rtf",
    ".odt": "application/vnd.oasis.opendocument.text",
    ".ods": "application/vnd.oasis.opendocument.spreadsheet",
    ".md": "text/markdown",
    ".html": "text/html",
    ".htm": "text/html",
    ".json": "application/json",
    ".xml": "application/xml",
    ".yaml": "application/x-yaml",
    ".yml": "application/x-yaml",
}
DEFAULT_MIME = "application/octet-stream"
ALLOWED_SCHEMES = ["https"]

# ---- fixed values: metric buckets ----------------------------------------
LATENCY_BUCKETS = [0.5, 1, 2.5, 5, 10, 30, 60, 120, 300, 600, 1800]
CONTENT_BUCKETS = [1024, 4096, 16384, 65536, 262144, 1048576]

# ---- fixed values: index schema gates ------------------------------------
REQUIRED_PATHS = [
    "payload.mergeForward.msgs.from",
    "payload.mergeForward.msgs.timestamp",
    "payload.richText.searchText",
    "parentMessageId",
    "parentPayloadType",
    "virtual",
    "subSeq",
    "payload.file.content",
    "payload.file.contentMeta.extractedAt",
    "payload.file.contentMeta.status",
    "payload.file.contentMeta.reason",
]
STORED_ONLY_PATHS = ["payloadRaw"]
READER_PATHS = [
    "messageId",
    "messageSeq",
    "channelId",
    "channelType",
    "from",
    "to",
    "spaceId",
    "visibles",
    "timestamp",
    "payload.type",
    "payload.text.content",
    "payload.image.caption",
    "payload.image.name",
    "payload.file.caption",
    "payload.file.name",
    "payload.file.extension",
    "payload.mergeForward.msgs.searchText",
    "payload.mergeForward.msgs.from",
    "payload.mergeForward.msgs.timestamp",
]
# analysed text fields of a document
TEXT_PATHS = [
    "payload.text.content",
    "payload.image.caption",
    "payload.image.name",
    "payload.file.name",
    "payload.file.caption",
    "payload.file.content",
    "payload.mergeForward.msgs.searchText",
    "payload.richText.searchText",
]
# keyword fields and the length beyond which a value is kept but not searchable
KEYWORD_LIMITS = {
    "from": 256,
    "to": 256,
    "channelId": 256,
    "spaceId": 256,
    "visibles": 256,
    "source": 64,
    "payload.image.url": 1024,
    "payload.gif.url": 1024,
    "payload.voice.url": 1024,
    "payload.video.url": 1024,
    "payload.video.cover": 1024,
    "payload.file.url": 1024,
    "payload.file.extension": 32,
    "payload.file.contentMeta.extractor": 32,
    "payload.file.contentMeta.status": 32,
    "payload.file.contentMeta.reason": 64,
    "payload.mergeForward.msgs.from": 256,
}

# ---- schemas (DDL text: usable before a session exists) ------------------------
ROW_FIELDS = [
    ("shard_table", "string"),
    ("id", "bigint"),
    ("message_id", "string"),
    ("message_seq", "bigint"),
    ("from_uid", "string"),
    ("channel_id", "string"),
    ("channel_type", "int"),
    ("setting", "int"),
    ("signal", "int"),
    ("timestamp", "bigint"),
    ("created_unix", "bigint"),
    ("payload", "binary"),
]
CONTRACT_FIELDS = [
    ("schema_version", "int"),
    ("message_id", "string"),
    ("message_seq", "bigint"),
    ("channel_id", "string"),
    ("channel_type", "int"),
    ("from_uid", "string"),
    ("content", "string"),
    ("content_type", "bigint"),
    ("raw_payload", "string"),
    ("raw_excluded", "boolean"),
    ("space_id", "string"),
    ("visibles", "array<string>"),
    ("msg_timestamp", "bigint"),
    ("created_at", "bigint"),
    ("source", "string"),
]
STREAM_FIELDS = [
    ("topic", "string"),
    ("partition", "int"),
    ("offset", "bigint"),
    ("key", "binary"),
    ("value", "binary"),
]
META_DDL = (
    "struct<extractedAt:bigint,extractor:string,truncated:boolean,"
    "extractMs:bigint,status:string,reason:string>"
)
FILE_DDL = (
    "struct<url:string,name:string,caption:string,size:bigint,extension:string,"
    f"content:string,contentMeta:{META_DDL}>"
)
PAYLOAD_DDL = (
    "struct<type:bigint,"
    "text:struct<content:string>,"
    "image:struct<url:string,caption:string,name:string,width:int,height:int>,"
    "gif:struct<url:string>,voice:struct<url:string>,"
    "video:struct<url:string,cover:string,width:int,height:int,second:int>,"
    f"file:{FILE_DDL},"
    "mergeForward:struct<childCount:int,msgs:array<struct<messageId:bigint,type:bigint,"
    "searchText:string,from:string,timestamp:bigint>>>,"
    "richText:struct<searchText:string>>"
)
DOC_FIELDS = [
    ("_id", "string"),
    ("schemaVersion", "int"),
    ("messageId", "bigint"),
    ("messageSeq", "bigint"),
    ("from", "string"),
    ("to", "string"),
    ("channelId", "string"),
    ("channelType", "int"),
    ("spaceId", "string"),
    ("visibles", "array<string>"),
    ("timestamp", "bigint"),
    ("createdAt", "bigint"),
    ("rawExcluded", "boolean"),
    ("source", "string"),
    ("payload", PAYLOAD_DDL),
    ("payloadRaw", "string"),
    ("parentMessageId", "bigint"),
    ("parentPayloadType", "int"),
    ("virtual", "boolean"),
    ("subSeq", "int"),
]
DOC_COLUMNS = [name for name, _ in DOC_FIELDS]


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)
