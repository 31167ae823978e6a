"""Stream of shard ranges into stream records and dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from searchloom.plans import incremental
from searchloom.sinks.pointer import VersionedPointer
from searchloom.sources import shardstream


def start(
    source: Callable[[], DataFrame], frontier: str, cursors: VersionedPointer, out: str, checkpoint: str, now_unix: Callable[[], int],
    topic: str = "messages", report: Callable[[int, dict], None] | None = None, **trigger,
) -> StreamingQuery:
    """Publish all rows up to the frontier, batch by batch; ``trigger`` as for writeStream, all available by default.

    ``source`` gives the shards as they are now (a frame would keep the list of files it was made
    with). A new checkpoint starts at the cursors. ``cursors`` and the names of what counts move together after each batch, so a
    batch that comes again after its commit publishes nothing, and readers of
    ``incremental.main_records`` see each record once. ``report`` gets the number and counts of each batch that published.
    """
    spark = source().sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        upto = {r["shard_table"]: r["upto"] for r in batch.collect()}  # one row per shard
        counters = Observation() if report else None
        if incremental.run_range(source(), upto, cursors, out, now_unix(), topic, counters) and report:
            report(batch_id, counters.get)

    known = incremental.progress(cursors)[1]["cursors"]
    return (
        shardstream.range_stream(spark, frontier, known)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
