"""Publish a new document table under one name, and step back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from searchloom.operators import gates
from searchloom.plans import reconcile
from searchloom.sinks.pointer import VersionedPointer


class ReadAlias:
    """The table readers use: a pointer to the current folder and the one before."""

    def __init__(self, spark: SparkSession, root: str):
        self.pointer = VersionedPointer(spark, root)

    def current(self) -> str | None:
        return self.pointer.read()[1].get("path")

    def publish(self, path: str, report: DataFrame, schema_of: DataFrame) -> bool:
        """Switch to ``path`` if its report is healthy and its schema complete; else raise."""
        reconcile.require_healthy(report)
        gates.require_compatible(schema_of.schema)
        gates.require_reader_fields(schema_of.schema)
        version, value = self.pointer.read()
        return self.pointer.commit(version, {"path": path, "before": value.get("path")})

    def rollback(self) -> bool:
        """Back to the folder before; a table that never had one stays."""
        version, value = self.pointer.read()
        if not value.get("before"):
            return False
        return self.pointer.commit(version, {"path": value["before"], "before": value["path"]})
