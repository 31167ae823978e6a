"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchloom.llm import conversations, decontaminate, fingerprints, licenses, line_dedup, mixing, mixing_sql, near_dedup, pii, quality, secret_scan, token_counts, url_templates, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # rows sent to Python at a time: texts are long, and an executor holds several batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: fixed values of the url rules
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    all_ = rows.select("conv_id").distinct()
    found = conversations.report(conversations.damaged(rows)).withColumnRenamed("conv_id", "found")
    out = all_.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").drop("found")
    # conversations that lost all their rows
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return out.select("conv_id", *[F.coalesce(c, none.get(c, F.lit(0))).alias(c) for c in out.columns[1:]])


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_templates": op1_url_templates,
    "op2_decontaminate": op2_decontaminate,
    "op3_license_scan": op3_license_scan,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_near_dedup": op7_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_personal_data": op10_personal_data,
    "op11_fingerprints": op11_fingerprints,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op6_mixing": mixing_sql.twin(),
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM bw),
lens AS (SELECT DISTINCT n FROM grams),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT doc_id, i, n, item FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM dw) JOIN grams USING (n, gram)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
