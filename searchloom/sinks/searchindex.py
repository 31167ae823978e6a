"""Stored inverted index of a document table: postings by word, kept up with the table's log.

An update indexes the documents that changed since the last one as a new segment, which also lists
their ids: of a document only the postings of its newest segment count, so a text that lost a
word, or all of them, is right at once. Postings lie in folders by hash of their word, sorted by word,
so a search opens the folders of its own words and, inside them, the row groups that can hold them;
no text is read. ``compact`` leaves one segment without dead postings. A common word may fill
several files of its folder.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.functions import textx
from searchloom.operators import search
from searchloom.sinks import tables
from searchloom.sinks.docstore import DROP, ConcurrentWrite, DocumentStore
from searchloom.sinks.pointer import VersionedPointer

BUCKETS = 64
POSTING_DDL = "token string, doc_id string, number bigint, field string, tf int, seq bigint"
ID_DDL = "doc_id string, seq bigint"


class SearchIndex:
    def __init__(self, store: DocumentStore, root: str, buckets: int = BUCKETS):
        self.store, self.spark, self.root, self.buckets = store, store.spark, root.rstrip("/"), buckets
        self.pointer = VersionedPointer(self.spark, f"{self.root}/_current")

    # -- building

    def update(self) -> bool:
        """Index what has changed in the table; false if nothing has.

        Ranges that were compacted since are indexed as a whole, as their log is gone, and so are ranges
        that hold nothing older; of all others only the documents that a delta names are read.
        """
        version, value = self._value()
        table = self.store.state()
        if table.last == value["upto"]:
            return False
        value["seq"] += 1
        whole = [int(s) for s, base in table.bases.items() if base["seq"] > value["upto"]]
        news = [e for e in table.log if e["seq"] > value["upto"]]
        fresh = {s for s in table.slots if all(e["seq"] > value["upto"] for e in table.layers(s))}
        paths = [f"{self.store.root}/{e['folder']}/slot={s}" for e in news if e["kind"] != DROP for s in e["slots"] if s not in fresh.union(whole)]
        frames = [self.store.read_at(table, sorted(fresh.union(whole)))]
        ids = [frames[0].select(F.col("_id").alias("doc_id"))]
        if paths:
            named = tables.staged(self.spark.read.schema("_id string").parquet(*paths).select(F.col("_id").alias("doc_id")).distinct(), "index-ids")
            ids.append(named)
            frames.append(self.store.read_ids(named, table))
        docs = functools.reduce(DataFrame.unionByName, frames)
        ids = functools.reduce(DataFrame.unionByName, ids)
        ranges = [(e["low"], e["high"]) for e in news if e["kind"] == DROP] + [self.store.bounds(s) for s in whole]
        value["drops"] += [{"seq": value["seq"], "low": low, "high": high} for low, high in ranges]
        value["segments"].append({"seq": value["seq"], "folder": self._write(self._indexed(docs, value["seq"]), ids.withColumn("seq", F.lit(value["seq"]).cast("bigint")))})
        value["upto"] = table.last
        self._commit(version, value)
        return True

    def compact(self) -> None:
        """One segment of what is alive now."""
        version, value = self._value()
        if len(value["segments"]) < 2 and not value["drops"]:
            return
        live = self._alive(value, self._read(value, "postings", POSTING_DDL, list(range(self.buckets))))
        none = self.spark.createDataFrame([], ID_DDL)
        folder = self._write(live.withColumn("seq", F.lit(value["seq"]).cast("bigint")), none)
        self._commit(version, {**value, "segments": [{"seq": value["seq"], "folder": folder}], "drops": []})

    def _indexed(self, docs: DataFrame, seq: int) -> DataFrame:
        number = F.regexp_extract("doc_id", r"^-?\d+", 0).try_cast("bigint")
        return search.inverted_index(docs).select("token", "doc_id", number.alias("number"), "field", F.col("tf").cast("int").alias("tf"), F.lit(seq).cast("bigint").alias("seq"))

    def _write(self, postings: DataFrame, ids: DataFrame) -> str:
        folder = uuid.uuid4().hex
        (
            postings.withColumn("bucket", self._bucket())
            .hint("rebalance", "bucket")  # a common word fills several files, rare ones share one
            .sortWithinPartitions("bucket", "token", "doc_id")
            .write.partitionBy("bucket")
            .parquet(f"{self.root}/{folder}/postings")
        )
        ids.write.parquet(f"{self.root}/{folder}/ids")
        return folder

    def _bucket(self):
        return F.pmod(F.xxhash64("token"), F.lit(self.buckets)).cast("int")

    # -- searching

    def match(self, query: str, field: str | None = None) -> DataFrame:
        """(doc_id, words, tf): documents with any word of the query in a field (or any), how many of its words, and how often."""
        return self.postings(query, field).groupBy("doc_id").agg(F.count_distinct("token").alias("words"), F.sum("tf").alias("tf"))

    def frequencies(self, query: str, field: str | None = None) -> DataFrame:
        """(token, documents) of the words of the query that are there."""
        return self.postings(query, field).groupBy("token").agg(F.count_distinct("doc_id").alias("documents"))

    def postings(self, query: str, field: str | None = None) -> DataFrame:
        """Live postings (token, doc_id, field, tf) of the words of a query; only their folders are opened."""
        words = F.explode(F.array_distinct(textx.tokens(F.lit(query))))
        wanted = self.spark.range(1).select(words.alias("token")).select("token", self._bucket().alias("bucket")).collect()
        _, value = self._value()
        rows = self._read(value, "postings", POSTING_DDL, sorted({r.bucket for r in wanted})).where(F.col("token").isin([r.token for r in wanted]))
        rows = rows if field is None else rows.where(F.col("field") == field)
        return self._alive(value, rows).select("token", "doc_id", "field", "tf")

    def _alive(self, value: dict, rows: DataFrame) -> DataFrame:
        """Postings of each document's newest segment that no later drop covers."""
        for d in value["drops"]:
            rows = rows.where(~(F.col("number").between(d["low"], d["high"] - 1) & (F.col("seq") < d["seq"])))
        later = {**value, "segments": value["segments"][1:]}
        if not later["segments"]:
            return rows
        newest = self._read(later, "ids", ID_DDL).groupBy("doc_id").agg(F.max("seq").alias("newest"))
        return rows.join(newest, "doc_id", "left").where(F.col("newest").isNull() | (F.col("seq") >= F.col("newest"))).drop("newest")

    def _read(self, value: dict, kind: str, ddl: str, buckets: list[int] | None = None) -> DataFrame:
        folders = [f"{self.root}/{s['folder']}/{kind}" for s in value["segments"]]
        if buckets is not None:
            folders = [p for f in folders for b in buckets if self._there(p := f"{f}/bucket={b}")]
        return self.spark.read.schema(ddl).parquet(*folders) if folders else self.spark.createDataFrame([], ddl)

    def _there(self, path: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _value(self) -> tuple[int, dict]:
        version, value = self.pointer.read()
        return version, {"upto": 0, "seq": 0, "segments": [], "drops": [], "contract": C.CONTRACT_VERSION, **value}

    def _commit(self, version: int, value: dict) -> None:
        if not self.pointer.commit(version, value):
            raise ConcurrentWrite(f"{self.root}: another job has changed the index")
