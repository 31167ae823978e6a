"""Append-once store of dead letters, in folders by hash of their key.

A run looks its keys up only in the folders that can hold them; a short list of keys goes into
the scan, where the Bloom filters of the files tell which need no reading. Files are never replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchloom.operators import deadletters
from searchloom.sinks import tables

BUCKETS = 32
#: keys up to this many become part of the scan
SCANNED_KEYS = 1000
WRITE_OPTIONS = {"parquet.bloom.filter.enabled#dedup_key": "true", "parquet.bloom.filter.expected.ndv#dedup_key": "100000"}


class LetterStore:
    def __init__(self, spark: SparkSession, root: str, ddl: str, buckets: int = BUCKETS):
        self.spark, self.root, self.ddl, self.buckets = spark, root.rstrip("/"), ddl, buckets

    def read(self) -> DataFrame:
        return tables.read_runs(self.spark, self.root, self.ddl).drop("bucket")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("dedup_key"), F.lit(self.buckets)).cast("int")

    def stored_keys(self, keys: DataFrame) -> DataFrame:
        """Keys (dedup_key, bucket) in the folders of these; of a short list the listed ones only."""
        touched = [r[0] for r in keys.select("bucket").distinct().collect()]
        stored = tables.read_runs(self.spark, self.root, f"{self.ddl}, bucket int")
        stored = stored.where(F.col("bucket").isin(touched)) if touched else stored.limit(0)
        listed = [r[0] for r in keys.select("dedup_key").limit(SCANNED_KEYS + 1).collect()]
        if len(listed) <= SCANNED_KEYS:
            stored = stored.where(F.col("dedup_key").isin(listed))
        return stored.select("dedup_key", "bucket")

    def append(self, letters: DataFrame, run: str) -> None:
        """Add the first letter of each key that is not stored yet, under a name of this attempt."""
        first = tables.staged(deadletters.first_per_key(letters).withColumn("bucket", self._bucket()), "letters")
        names = [f.name for f in self.spark.createDataFrame([], self.ddl).schema.fields]
        fresh = first.join(self.stored_keys(first).distinct(), ["dedup_key", "bucket"], "left_anti").select(*names, "bucket")
        fresh.write.options(**WRITE_OPTIONS).partitionBy("bucket").parquet(f"{self.root}/run={run}-{uuid.uuid4().hex[:8]}")
