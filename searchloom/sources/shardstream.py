"""Growing shards as a streaming source: offsets are cursor maps, the latest offset is the stable prefix.

Two parts share a small versioned pointer, the frontier. ``publish`` is a Spark job: it finds the end
of the stable prefix of every shard above the frontier and moves the frontier there. ``ShardRanges`` is
the source: its latest offset is the frontier as it stands, and a batch holds one row per shard that
moved, (``above``, ``upto``]. Rows do not pass through the source; whoever takes a batch scans the ranges with
the reader of the shards, where bounds on ids reach the files. As everything up to the frontier is
stable, a range holds the same rows whenever it is read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from searchloom.operators import gates, stability
from searchloom.sinks import tables
from searchloom.sinks.pointer import VersionedPointer, newest_value
from searchloom.sources import shards

FORMAT = "shard_ranges"
RANGE_DDL = "shard_table string, above bigint, upto bigint"


def publish(rows: DataFrame, frontier: VersionedPointer, now_unix: int, lag: int) -> dict[str, int]:
    """Move the frontier to the end of the stable prefix of each shard; returns it.

    Reads three columns of the rows above the frontier. Of two publishers at a time the slower one leaves
    the frontier of the other.
    """
    gates.require_lag(lag)
    version, value = frontier.read()
    current = value.get("cursors", {})
    # read once: a row committed after the bound was found must not slip in below it
    seen = tables.staged(rows.where(shards.above_cursors(current)).select("shard_table", "id", "created_unix"), "frontier-rows")
    ends = stability.next_cursors(stability.stable_prefix(seen, now_unix - lag)).collect()  # one row per shard
    tables.release(seen)
    moved = {**current, **{s: max(end, current.get(s, 0)) for s, end in ends}}
    if moved == current or frontier.commit(version, {"cursors": moved}):
        return moved
    return frontier.read()[1]["cursors"]


class _Range(InputPartition):
    def __init__(self, shard: str, above: int, upto: int):
        super().__init__((shard, above, upto))


class _RangeReader(DataSourceStreamReader):
    def __init__(self, frontier: str, first: dict[str, int]):
        self.frontier, self.first = frontier, first

    def initialOffset(self) -> dict:
        return dict(sorted(self.first.items()))

    def latestOffset(self) -> dict:
        # in one order, as offsets are compared as texts
        return dict(sorted({**self.first, **newest_value(self.frontier).get("cursors", {})}.items()))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Range(shard, start.get(shard, 0), upto) for shard, upto in sorted(end.items()) if upto > start.get(shard, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield partition.value


class ShardRanges(DataSource):
    """Options: ``frontier``, the folder of the pointer; ``cursors``, a JSON map to start from (0 for shards not in it)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RANGE_DDL

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _RangeReader(self.options["frontier"], json.loads(self.options.get("cursors", "{}")))


def range_stream(spark: SparkSession, frontier: str, cursors: dict[str, int] | None = None) -> DataFrame:
    """(shard_table, above, upto) of every shard whose frontier has moved since the last batch."""
    spark.dataSource.register(ShardRanges)
    return spark.readStream.format(FORMAT).option("frontier", frontier).option("cursors", json.dumps(cursors or {})).load()


def keep_publishing(
    source: Callable[[], DataFrame], frontier: VersionedPointer, lag: int, now_unix: Callable[[], int], checkpoint: str,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Publish the frontier at an interval, for streams that run on; ``source`` lists the shards anew each time."""
    ticks = source().sparkSession.readStream.format("rate").load()
    return (
        ticks.writeStream.foreachBatch(lambda batch, number: publish(source(), frontier, now_unix(), lag) and None)
        .option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    )
