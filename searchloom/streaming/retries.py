"""File texts from a stream, waiting messages kept as keyed state with timers.

The state holds only messages whose text waits for its document, one per message id, with a timer for
the next attempt. What an attempt leaves open is written below the leg's folder and read as a second
input of the same stream, so it is in the very next batch: of a message that waits and is delivered
again, the newest place counts, and an older one never comes back. Timers fire without input, as
Spark runs batches for them at every trigger; state and timers are in the checkpoint.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from searchloom import contract as C
from searchloom.operators import delivery
from searchloom.sinks import tables
from searchloom.streaming.extraction import BACKOFF_BASE, BACKOFF_CAP, WORK_DDL, FileLeg, decoded_files

WORK_COLUMNS = [c.split()[0] for c in WORK_DDL.split(", ")]
ORDER = ["partition", "offset", "attempts"]
SHUFFLE_PARTS = "spark.sql.shuffle.partitions"
#: partitions of the state: at most so many for each core, where these are not fewer than the least
LEAST_PARTS, PARTS_A_CORE = 32, 2


class Retries(StatefulProcessor):
    """Passes deliveries on at once, and waiting messages when their time has come.

    A row with ``attempts`` 0 is a delivery, with more an attempt that found no document.
    """

    def __init__(self, base: float = BACKOFF_BASE, cap: float = BACKOFF_CAP):
        self.base, self.cap = base, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", WORK_DDL)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        place = lambda r: tuple(r[WORK_COLUMNS.index(c)] for c in ORDER)
        newest = max((tuple(r[c] for c in WORK_COLUMNS) for r in rows), key=place)
        held = tuple(self.waiting.get()) if self.waiting.exists() else None
        if held is not None:
            if place(newest) <= place(held):
                return
            self._let_go()
        attempts = newest[WORK_COLUMNS.index("attempts")]
        if attempts == 0:
            yield Row(**dict(zip(WORK_COLUMNS, newest, strict=True)))
            return
        wait = min(self.base * 2 ** min(attempts - 1, 60), self.cap)
        self.waiting.update(newest)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + math.ceil(1000 * wait))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.waiting.exists():
            due = tuple(self.waiting.get())
            self.waiting.clear()
            yield Row(**dict(zip(WORK_COLUMNS, due, strict=True)))

    def _let_go(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.waiting.clear()

    def close(self) -> None:
        pass


def work_stream(records: DataFrame, waiting: DataFrame, processor: Retries) -> DataFrame:
    """Messages to try in each batch, and with a ``reason`` the records that are no contract message."""
    found, bad = decoded_files(tables.spread(records))
    # as much as a letter keeps, and one byte that says there was more
    kept = F.substring("value", 1, C.MAX_DLQ_PAYLOAD_BYTES + 1)
    fresh = found.withColumn("attempts", F.lit(0)).withColumn("value", kept).select(*WORK_COLUMNS)
    tries = fresh.unionByName(waiting.select(*WORK_COLUMNS)).groupBy("message_id").transformWithState(
        processor, WORK_DDL, outputMode="Append", timeMode="ProcessingTime"
    )
    return tries.withColumn("reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def start(
    records: DataFrame, leg: FileLeg, checkpoint: str, base: float = BACKOFF_BASE, cap: float = BACKOFF_CAP,
    now_unix: Callable[[], int] = lambda: int(time.time()), parts: int | None = None, **trigger,
) -> StreamingQuery:
    """Extract files from a stream of records until it is stopped; a trigger a second by default.

    Writes letters and texts as ``extraction.start`` does. Needs the RocksDB state store, which
    ``session.configure`` sets. ``leg`` must be used by one checkpoint only, whose state has ``parts`` partitions
    from its first batch on (``state_parts`` if not given).
    """
    leg.store.check_stored()
    spark, folder = leg.store.spark, f"{leg.root}/open"
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]
    spark.createDataFrame([], WORK_DDL).write.mode("overwrite").parquet(f"{folder}/{name}-start")  # the source wants a folder
    waiting = spark.readStream.schema(WORK_DDL).option("cleanSource", "delete").parquet(f"{folder}/*")

    def each(batch: DataFrame, batch_id: int) -> None:
        taken = tables.staged(batch, "file-tries")  # evaluated once: it moves the state
        if not taken.isEmpty():
            work = taken.where(F.col("reason").isNull()).drop("reason")
            work = tables.staged(delivery.latest_delivery(work, "message_id", ORDER).select(*WORK_COLUMNS), "file-work")
            bad = taken.where(F.col("reason").isNotNull())
            run = f"{name}-{batch_id:012d}"
            again = leg.attempt(work, bad, run, now_unix())
            again.select(*WORK_COLUMNS).write.mode("overwrite").parquet(f"{folder}/{run}")
            tables.release(work)
        tables.release(taken)

    writer = (
        work_stream(records, waiting, Retries(base, cap))
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
    )
    size = spark.conf.get(SHUFFLE_PARTS)
    spark.conf.set(SHUFFLE_PARTS, str(parts or state_parts(spark)))
    try:
        return writer.start()  # the stream keeps a copy of the settings
    finally:
        spark.conf.set(SHUFFLE_PARTS, size)


def state_parts(spark: SparkSession) -> int:
    """Partitions of the state: as many as shuffles have, but few for each core.

    Every batch starts a worker and commits a store for each of them, which takes a core some tenths of a second even
    when nothing waits.
    """
    most = max(LEAST_PARTS, PARTS_A_CORE * spark.sparkContext.defaultParallelism)
    return min(int(spark.conf.get(SHUFFLE_PARTS)), most)


def drained(query: StreamingQuery) -> bool:
    """Whether nothing came in and nothing waits. The last two batches say so: what one leaves open, the next one reads."""
    last = query.recentProgress[-2:]
    return len(last) == 2 and all(p.numInputRows == 0 and sum(o.numRowsTotal for o in p.stateOperators) == 0 for p in last)


def run_until_drained(query: StreamingQuery, timeout: float | None = None, stalled: float = 600.0) -> bool:
    """Let a stream run until it is drained, then stop it; false if it was not in time.

    A long input takes as long as it takes: without a ``timeout`` for the whole, time is up when batches
    took nothing in for ``stalled`` seconds and texts still wait.
    """
    begun = fed = time.monotonic()
    last = None
    try:
        while not (done := drained(query)):
            if query.awaitTermination(1):  # raises what the stream failed with
                return False
            now, ended = time.monotonic(), query.lastProgress
            # none has ended, or the last one took something in: the next one may be as long
            if ended is None or (ended.numInputRows and ended.batchId != last):
                fed, last = now, ended and ended.batchId
            idle = ended is not None and not ended.numInputRows
            if (timeout is not None and now - begun >= timeout) or (idle and now - fed >= stalled):
                return drained(query)
        return done
    finally:
        query.stop()
