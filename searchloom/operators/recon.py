"""Proof that documents match their source: counts, samples, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.functions import jsonx
from searchloom.operators.enrich import is_encrypted
from searchloom.sinks import tables

MAX_DETAILS = 50


def source_count(rows: DataFrame, from_unix: int, to_unix: int) -> DataFrame:
    """Rows per shard created inside the window (both ends included)."""
    return (
        rows.where(F.col("created_unix").between(from_unix, to_unix))
        .groupBy("shard_table")
        .agg(F.count(F.lit(1)).alias("source_rows"))
    )


def doc_counts(docs: DataFrame, from_unix: int, to_unix: int) -> DataFrame:
    """Documents and excluded documents inside the window.

    Derived documents are left out of the first count only: they have no source row.
    """
    return docs.where(F.col("createdAt").between(from_unix, to_unix)).agg(
        F.count_if(~F.coalesce("virtual", F.lit(False))).alias("doc_count"),
        F.count_if(F.coalesce("rawExcluded", F.lit(False))).alias("raw_excluded"),
    )


def reconcile(source: DataFrame, docs: DataFrame, letters: DataFrame) -> DataFrame:
    """Verdict from three count frames: source_rows; doc_count and raw_excluded; dlq_keys.

    docs must equal source rows less dead letters. Counts that cannot be right give the
    verdict ``invalid`` and no difference. ``source`` may have one row per shard.
    """
    names = ["source_rows", "doc_count", "raw_excluded", "dlq_keys"]
    given = [source.select("source_rows"), docs.select("doc_count", "raw_excluded"), letters.select("dlq_keys")]
    parts = given[0].unionByName(given[1], allowMissingColumns=True).unionByName(given[2], allowMissingColumns=True)
    totals = parts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    source_, docs_, excluded, dlq = (F.col(n) for n in names)
    invalid = (F.least(*names) < 0) | (dlq > source_) | (excluded > docs_)
    return totals.select(
        *names,
        F.when(~invalid, source_ - dlq).alias("expected"),
        F.when(~invalid, docs_ - (source_ - dlq)).alias("diff"),
        F.when(invalid, F.lit("invalid")).when(docs_ == source_ - dlq, F.lit("ok")).otherwise(F.lit("mismatch")).alias("verdict"),
    )


# ---- field samples -------------------------------------------------------------
def expected_fields(rows: DataFrame) -> DataFrame:
    """Fields the documents must show, read from the source on a path of its own.

    The access list is read here without the expression of the write path on purpose:
    a fault there would otherwise hide itself.
    """
    opened = jsonx.with_json_object(
        rows.withColumn("_text", F.make_valid_utf8(F.col("payload").cast("string"))),
        "_text", "_top", ["space_id", "visibles"], allow_empty=True,
    )

    def quoted(v: Column) -> Column:
        # only strings are written with a leading quote
        return F.when(F.to_json(v).startswith('"'), F.try_variant_get(v, "$", "string"))

    hidden = is_encrypted()
    names = F.filter(
        F.transform(F.try_variant_get("_top.visibles", "$", "array<variant>"), quoted),
        lambda s: s.isNotNull() & (s != ""),
    )
    return opened.select(
        "shard_table", "id", "message_id", "message_seq", "channel_id", "channel_type", "created_unix",
        hidden.alias("encrypted"),
        F.when(~hidden, F.coalesce(quoted(F.col("_top.space_id")), F.lit(""))).alias("space_id"),
        F.when(~hidden, names).alias("visibles"),
    )


def sample(rows: DataFrame, from_unix: int, to_unix: int, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of the window by message_id: always the same ones.

    The limit is a top-k: each task keeps its own best, the driver-side merge sees
    limit rows per task. None takes every row.
    """
    rows = rows.where(F.col("created_unix").between(from_unix, to_unix))
    return rows if limit is None else rows.orderBy("message_id", "shard_table", "id").limit(limit)


def comparable_sample(
    rows: DataFrame, excluded: DataFrame, from_unix: int, to_unix: int, limit: int | None
) -> DataFrame:
    """Sample of rows that should have a document: no empty ids, no dead-lettered ids.

    Only keys are compared and ranked, so no payload is moved or parsed for it; the few
    rows picked are then fetched by a semi-join.
    """
    inside = rows.where(F.col("created_unix").between(from_unix, to_unix) & (F.coalesce("message_id", F.lit("")) != ""))
    if limit is None:
        return inside.join(excluded.select("message_id"), "message_id", "left_anti")
    keys = inside.select("message_id", "shard_table", "id").join(excluded.select("message_id"), "message_id", "left_anti")
    picked = tables.staged(keys.orderBy("message_id", "shard_table", "id").limit(limit), "sample-keys")
    return rows.join(picked, ["message_id", "shard_table", "id"], "left_semi")


def compare(expected: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per field that differs, or a ``_doc`` row where the document is missing.

    ``expected`` is a sample and read twice, so give a written one: the documents are cut down to
    its ids before they meet it, by a semi-join whose small side the planner can broadcast.
    """
    wanted = expected.select(F.col("message_id").alias("_id"))
    e, d = expected.alias("e"), docs.join(wanted, "_id", "left_semi").alias("d")
    joined = e.join(d, F.col("e.message_id") == F.col("d._id"), "left")
    seen = F.col("d._id").isNotNull()

    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("0"))

    def listed(c: Column) -> Column:
        return F.concat(F.lit("["), F.coalesce(F.array_join(F.array_sort(c), " "), F.lit("")), F.lit("]"))

    open_ = ~F.col("e.encrypted")
    checks = [
        ("messageId", F.col("e.message_id"), text(F.col("d.messageId")), F.lit(True)),
        ("messageSeq", text(F.col("e.message_seq")), text(F.col("d.messageSeq")), F.lit(True)),
        ("channelId", F.col("e.channel_id"), F.coalesce("d.channelId", F.lit("")), F.lit(True)),
        ("channelType", text(F.col("e.channel_type")), text(F.col("d.channelType")), F.lit(True)),
        ("spaceId", F.col("e.space_id"), F.coalesce("d.spaceId", F.lit("")), open_),
    ]
    found = [
        F.when(seen & on & (mine != theirs), F.struct(F.lit(f).alias("field"), mine.alias("source"), theirs.alias("doc")))
        for f, mine, theirs, on in checks
    ]
    lists_differ = ~lists_equal(F.col("e.visibles"), F.col("d.visibles"))
    found.append(
        F.when(
            seen & open_ & lists_differ,
            F.struct(
                F.lit("visibles").alias("field"),
                listed(F.col("e.visibles")).alias("source"),
                listed(F.col("d.visibles")).alias("doc"),
            ),
        )
    )
    found.append(
        F.when(~seen, F.struct(F.lit("_doc").alias("field"), F.lit("present").alias("source"), F.lit("missing").alias("doc")))
    )
    return joined.select(
        F.col("e.message_id").alias("message_id"), F.explode(F.array_compact(F.array(*found))).alias("m")
    ).select("message_id", "m.*")


def lists_equal(a: Column, b: Column) -> Column:
    """Same strings with the same counts in any order; null counts as empty."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.coalesce(a, none)) == F.array_sort(F.coalesce(b, none))


def first_details(details: DataFrame, limit: int = MAX_DETAILS) -> DataFrame:
    """The first difference rows of a report."""
    return details.orderBy("message_id", "field").limit(limit)


def sample_health(expected: DataFrame, details: DataFrame) -> DataFrame:
    """Rows compared, rows without document, rows with any differing field."""
    per_row = details.groupBy("message_id").agg(F.bool_or(F.col("field") == "_doc").alias("gone"))
    found = per_row.select(
        F.lit(0).alias("sampled"),
        F.when(F.col("gone"), 1).otherwise(0).alias("missing"),
        F.when(F.col("gone"), 0).otherwise(1).alias("mismatch"),
    )
    rows = expected.select(F.lit(1).alias("sampled"), F.lit(0).alias("missing"), F.lit(0).alias("mismatch"))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("sampled", "missing", "mismatch")]
    return rows.unionByName(found).agg(*sums)


def full_report(verdict: DataFrame, health: DataFrame) -> DataFrame:
    """Count verdict and sample result in one row; healthy only when both are clean."""
    names = ["source_rows", "doc_count", "sampled", "missing", "mismatch"]
    both = verdict.select(
        "source_rows", "doc_count", (F.col("verdict") == "ok").alias("counts_ok")
    ).unionByName(health, allowMissingColumns=True)
    return both.agg(*[F.max(n).alias(n) for n in names], F.bool_and("counts_ok").alias("counts_ok")).withColumn(
        "healthy", F.col("counts_ok") & (F.col("missing") == 0) & (F.col("mismatch") == 0)
    )


def push_payload(report: DataFrame, ran_at: int) -> DataFrame:
    """What the gauges get: counts and all sample faults as one number."""
    return report.select(
        F.col("doc_count").alias("es_doc_count"),
        F.col("source_rows").alias("mysql_row_count"),
        (F.col("mismatch") + F.col("missing")).alias("sample_mismatch"),
        F.lit(ran_at).cast("bigint").alias("ran_at_unix_seconds"),
    )


def order_clashes(docs: DataFrame) -> DataFrame:
    """Result-order keys held by more than one document; paging would lose all but one."""
    return (
        docs.groupBy("timestamp", "messageId", "subSeq")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") > 1)
    )
