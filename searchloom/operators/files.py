"""Text of attached files: which to fetch, how to extract, how failures are routed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import jsonx, netx, textx

NATIVE_LABEL = "spark-sql/1"
PLAIN_MIMES = ["text/plain", "text/csv", "text/markdown", "application/json", "application/xml", "application/x-yaml"]
HTML_MIME = "text/html"
# no plug-in was there to read the format: nothing is wrong with the file, and it stays pending
NO_EXTRACTOR = "no_extractor"
FILE_FIELDS = ["type", "url", "name", "extension", "size"]

# a plug-in turns batches of (url, body, ext) into (content, error_kind, extract_ms): one row for
# each row, in the same order; error_kind is null, encrypted, extract_timeout or extract_error
Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def pending_files(docs: DataFrame) -> DataFrame:
    """File documents without text that are not marked as unextractable."""
    status = F.col("payload.file.contentMeta.status")
    return docs.where(
        (F.col("payload.type") == C.TYPE_FILE)
        & F.col("payload.file.content").isNull()
        & ~status.eqNullSafe(F.lit(C.TOMBSTONE_STATUS))
    ).select(
        F.col("_id").alias("message_id"),
        F.col("payload.file.url").alias("url"),
        F.col("payload.file.name").alias("name"),
        F.col("payload.file.extension").alias("extension"),
        F.col("payload.file.size").alias("size"),
    )


def file_messages(messages: DataFrame) -> DataFrame:
    """Contract messages whose payload type is the integer 8, with their file fields.

    The cheap text test runs first: almost no message is a file. The place in the stream
    and the record itself come along where they are there.
    """
    keep = [c for c in ("topic", "partition", "offset", "key", "value") if c in messages.columns]
    likely = messages.where(F.contains("raw_payload", F.lit("8")))
    opened = jsonx.with_json_object(likely, "raw_payload", "file", FILE_FIELDS, allow_empty=True)
    fields = F.struct(
        F.col("message_id").alias("message_id"),
        jsonx.string_of(F.col("file.url")).alias("url"),
        jsonx.string_of(F.col("file.name")).alias("name"),
        jsonx.string_of(F.col("file.extension")).alias("extension"),
        # unlike the document, this leg takes a size from a number only
        jsonx.integer_of(F.col("file.size")).alias("size"),
        *[F.col(c) for c in keep],
    )
    return opened.select(F.inline(F.when(jsonx.integer_of(F.col("file.type")) == C.TYPE_FILE, F.array(fields))))


def with_precheck(files: DataFrame, hosts: list[str], max_bytes: int = C.MAX_FILE_BYTES) -> DataFrame:
    """Reason to refuse a file before fetching it; the first failing check counts."""
    ext = textx.extension_field_first(F.col("extension"), F.col("name"))
    return files.withColumn("ext", ext).withColumn(
        "reason",
        F.when(F.col("ext").isin(C.SKIPPED_EXTENSIONS), F.lit("blacklist_ext"))
        .when(F.col("size") > max_bytes, F.lit("oversize"))
        .when(~netx.url_allowed(F.col("url"), hosts), F.lit("invalid_url")),
    )


def native_text(body: Column, mime: Column) -> Column:
    """Text of plain and HTML files by built-in expressions; null for other formats."""
    text = F.make_valid_utf8(body.cast("string"))
    return F.when(mime == HTML_MIME, textx.html_text(text)).when(mime.isin(PLAIN_MIMES), text)


def extract(fetched: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Content and error_kind of (url, ext, body), in one pass over the bytes.

    Formats Spark can read by expressions never leave the JVM; the bytes of the others go
    to the plug-in in Arrow batches, or count as no_extractor without one. A null body
    gives neither content nor error. Arrow batches are bounded in rows and bytes by
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``; bodies are
    already limited by the caller.
    """
    mime = textx.mime_type(F.col("ext"))
    inside = mime.isin([HTML_MIME, *PLAIN_MIMES])
    native = fetched.select(
        "url", "ext",
        native_text(F.col("body"), mime).alias("content"),
        F.when(~inside & F.col("body").isNotNull(), F.lit(NO_EXTRACTOR)).alias("error_kind"),
        F.lit(NATIVE_LABEL).alias("extractor"),
        F.lit(0).cast("bigint").alias("extract_ms"),
        F.when(~inside, F.col("body")).alias("body"),
    )
    if extractor is None:
        return native.drop("body")
    label = getattr(extractor, "label", "plugin")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            open_ = batch.loc[batch["body"].notna(), ["url", "body", "ext"]].reset_index(drop=True)
            if len(open_):
                done = pd.concat(list(extractor(iter([open_]))), ignore_index=True)
                if len(done) != len(open_):
                    raise ValueError(f"the extractor gave {len(done)} results for {len(open_)} files")
                yield done.assign(url=open_["url"], ext=open_["ext"], extractor=label)[OUT]
            yield batch.loc[batch["body"].isna(), OUT]

    OUT = ["url", "ext", "content", "error_kind", "extractor", "extract_ms"]
    return native.mapInPandas(
        run, "url string, ext string, content string, error_kind string, extractor string, extract_ms bigint"
    )


def extract_files(
    files: DataFrame,
    store: DataFrame,
    hosts: list[str],
    max_file_bytes: int = C.MAX_FILE_BYTES,
    max_content_bytes: int = C.MAX_CONTENT_BYTES,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Outcome of every pending file: content, or the reason why there is none.

    ``store`` holds (url, body), unique by url. Each address is fetched and extracted
    once however many messages carry it, and only the cut text is joined back; a popular
    file is spread by the adaptive skew join. ``files`` is read twice: give a written table.
    """
    checked = with_precheck(files, hosts, max_file_bytes)
    wanted = checked.where(F.col("reason").isNull()).select("url", "ext").distinct()
    large = F.octet_length("body") > max_file_bytes
    fetched = wanted.join(store, "url").withColumn("large", large)
    texts = extract(fetched.withColumn("body", F.when(~F.col("large"), F.col("body"))), extractor)
    cut = textx.cut_utf8(F.col("content"), max_content_bytes)
    # what is kept must not be blank
    blank = F.coalesce(textx.is_blank(cut), F.lit(True))
    results = texts.select(
        "url", "ext",
        cut.alias("content"),
        (F.octet_length("content") > max_content_bytes).alias("truncated"),
        F.when(F.col("error_kind").isin("encrypted", "extract_timeout", NO_EXTRACTOR), F.col("error_kind"))
        .when(F.col("error_kind").isNotNull(), F.lit("extract_error"))
        .when(F.col("content").isNull(), F.lit("oversize"))
        .when(blank, F.lit("empty_extract"))
        .alias("failure"),
        "extractor", "extract_ms",
        F.lit(True).alias("found"),
    )
    # gone from the store, else what extraction said; refused files need nothing from the join
    reason = F.when(F.col("found").isNull(), F.lit("download_failed")).otherwise(F.col("failure"))
    rest = [c for c in files.columns if c not in ("message_id", "url", "ext", "size")]
    tried = checked.where(F.col("reason").isNull()).join(results, ["url", "ext"], "left").withColumn("outcome", reason)
    refused = checked.where(F.col("reason").isNotNull()).withColumn("outcome", F.col("reason"))
    good = F.col("outcome").isNull()
    names = ["message_id", "url", "ext", "size", *rest]
    return tried.select(
        *names,
        F.coalesce("outcome", F.lit("ok")).alias("outcome"),
        F.when(good, F.col("content")).alias("content"),
        F.when(good, F.col("truncated")).alias("truncated"),
        "extractor", "extract_ms",
    ).unionByName(refused.select(*names, "outcome"), allowMissingColumns=True)


def is_permanent(reason: Column) -> Column:
    """Whether the reason leaves a tombstone."""
    return F.coalesce(reason.isin(C.TOMBSTONE_REASONS), F.lit(False))


def backfill_gate(outcomes: DataFrame, dlq_ratio_max: float = 0.10) -> DataFrame:
    """Totals of a backfill run over (outcome); failed when anything is open or too much was refused."""
    totals = outcomes.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("outcome") == "ok").alias("extracted"),
        F.count_if(~F.col("outcome").isin("ok", "transient", NO_EXTRACTOR)).alias("dlq"),
        F.count_if(F.col("outcome").isin("transient", NO_EXTRACTOR)).alias("transient"),
    )
    ratio = F.when(F.col("scanned") > 0, F.col("dlq") / F.col("scanned")).otherwise(F.lit(0.0))
    return totals.withColumn(
        "verdict",
        F.when(F.col("transient") > 0, F.lit("open_items"))
        .when(ratio > dlq_ratio_max, F.lit("too_many_dead_letters"))
        .otherwise(F.lit("ok")),
    )
