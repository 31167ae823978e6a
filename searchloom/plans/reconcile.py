"""Prove a document table against its source and gate what follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.operators import deadletters, gates, recon
from searchloom.sinks import tables


def verdict(rows: DataFrame, docs: DataFrame, letters: DataFrame, from_unix: int, to_unix: int) -> DataFrame:
    """Counts of the window and their verdict in one row."""
    gates.require_window(from_unix, to_unix)
    return recon.reconcile(
        recon.source_count(rows, from_unix, to_unix),
        recon.doc_counts(docs, from_unix, to_unix),
        deadletters.window_count(letters, from_unix, to_unix),
    )


def report(
    rows: DataFrame, docs: DataFrame, letters: DataFrame, from_unix: int, to_unix: int, sample: int | None = 1000
) -> DataFrame:
    """Full report: counts and a field sample of the rows that should have documents."""
    excluded = deadletters.window_ids(letters, from_unix, to_unix)
    # only ids are compared and ranked; the few rows left are then parsed, once
    picked = recon.comparable_sample(rows, excluded, from_unix, to_unix, sample)
    expected = tables.staged(recon.expected_fields(picked), "recon-sample")
    health = recon.sample_health(expected, recon.compare(expected, docs))
    return recon.full_report(verdict(rows, docs, letters, from_unix, to_unix), health)


def require_healthy(report_: DataFrame) -> None:
    """Raise unless the report is clean."""
    row = report_.first()
    if row is None or not row["healthy"]:
        raise gates.GateError(f"documents do not match their source: {row}")


def require_valid(verdict_: DataFrame) -> None:
    row = verdict_.where(F.col("verdict") == "invalid").first()
    if row is not None:
        raise gates.GateError(f"counts cannot be right: {row}")
