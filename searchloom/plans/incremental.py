"""One tick of the realtime leg: stable rows to stream records and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.operators import deadletters, enrich, gates, limits, metrics, stability, wire
from searchloom.sinks import tables
from searchloom.sinks.pointer import VersionedPointer
from searchloom.sources import shards

ROW_KEEP = ["shard_table", "id", "message_id", "channel_id", "channel_type", "payload", "created_unix", "timestamp"]


def planned(rows: DataFrame, now_unix: int, lag: int, limit: int = C.MAX_MESSAGE_BYTES) -> DataFrame:
    """Stable rows with their message and leg (main or dlq). ``rows`` is read twice: of a live source, give a written scan."""
    gates.require_lag(lag)
    return judged(stability.stable_prefix(rows, now_unix - lag), limit)


def judged(stable: DataFrame, limit: int = C.MAX_MESSAGE_BYTES) -> DataFrame:
    """Rows with their message and leg (main or dlq)."""
    routed = enrich.with_route(stable)
    parts = routed.select(
        F.struct(*ROW_KEEP).alias("row"), "outcome", F.col("reason").alias("why"), F.struct(*enrich.message_columns()).alias("m")
    )
    sized = limits.degrade_oversize(parts.select("row", "outcome", "why", "m.*"), limit)
    oversize = (F.col("outcome") != enrich.ROUTE_DLQ) & (F.col("fit") == "oversize")
    return sized.withColumn(
        "why", F.coalesce("why", F.when(oversize, F.lit(C.PRODUCER_OVERSIZE)))
    ).withColumn("leg", F.when(F.col("why").isNull(), F.lit("main")).otherwise(F.lit("dlq"))).withColumn(
        # a message holds its payload already
        "row", F.col("row").withField("payload", F.when(F.col("leg") == "dlq", F.col("row.payload")))
    )


#: names of published runs that stay in the pointer; more are folded into a file that it names
RUNS_IN_POINTER = 1000
MAIN_DDL = "topic string, key binary, value binary"


def progress(cursors: VersionedPointer) -> tuple[int, dict]:
    """(version, cursors by shard, and the runs that count) of a leg."""
    version, value = cursors.read()
    return version, {"cursors": {}, "runs": [], "folded": [], **value}


def run_tick(
    rows: DataFrame, cursors: VersionedPointer, out: str, now_unix: int, lag: int, topic: str = "messages", counters: Observation | None = None
) -> dict[str, int]:
    """Publish the stable rows above the cursors, then move the cursors to the prefix end.

    Main records first, then dead letters, then one compare-and-set that moves the cursors and
    names what this tick has written. Readers take named runs only, so a tick that fails or
    loses the race leaves files behind that nobody sees, and each record is seen once. Returns
    the cursors now valid. ``counters`` is filled on the way: ``items``, ``ok`` (main) and each reason.
    """
    version, state = progress(cursors)
    current = state["cursors"]
    # the source is read once: a row committed after the bound was found must not slip in below it
    seen = tables.staged(shards.scan(rows, current), "tick-rows")
    plan = _counted(planned(seen, now_unix, lag), counters)
    ends = stability.next_cursors(plan.select("row.shard_table", "row.id")).collect()  # one row per shard
    moved = {**current, **{s: max(end, current.get(s, 0)) for s, end in ends}}
    published = _publish(plan, version, state, moved, cursors, out, topic, now_unix)
    return moved if published else progress(cursors)[1]["cursors"]


def run_range(
    rows: DataFrame, upto: dict[str, int], cursors: VersionedPointer, out: str, now_unix: int, topic: str = "messages", counters: Observation | None = None
) -> bool:
    """Publish the rows above the cursors up to given ids, which must be stable; false if the cursors were there already.

    Raises if other jobs moved the cursors meanwhile: the same call again takes what is left.
    """
    version, state = progress(cursors)
    current = state["cursors"]
    ahead = {s: end for s, end in upto.items() if end > current.get(s, 0)}
    if not ahead:
        return False
    plan = _counted(judged(shards.scan_between(rows, current, ahead)), counters)
    if not _publish(plan, version, state, {**current, **ahead}, cursors, out, topic, now_unix):
        raise LostRace(f"another job publishes below {out}")
    return True


class LostRace(RuntimeError):
    """Another job moved the cursors first."""


def _counted(plan: DataFrame, counters: Observation | None) -> DataFrame:
    """The plan written by leg, its outcomes counted on the way."""
    by = metrics.reasons("why", [C.PRODUCER_UNPARSEABLE, C.PRODUCER_UNTRUSTED, C.PRODUCER_OVERSIZE])
    return tables.staged(metrics.observed(plan, counters, by), "tick", partition_by="leg")


def _publish(plan: DataFrame, version: int, state: dict, moved: dict[str, int], cursors: VersionedPointer, out: str, topic: str, now_unix: int) -> bool:
    """Write both legs, then name them and move the cursors at once; true if that holds now."""
    if moved == state["cursors"]:
        return True
    letters = plan.where(F.col("leg") == "dlq").select("row.*", F.col("why").alias("reason"))
    tick = f"{version + 1:012d}"
    main = tables.append_run(wire.encode(plan.where(F.col("leg") == "main"), topic), f"{out}/main", tick)
    stamped = deadletters.producer_letters(letters).withColumn("produced_at", F.lit(now_unix).cast("bigint"))
    dlq = tables.append_run(stamped, f"{out}/dlq", tick)
    run = {"main": main.rsplit("/", 1)[1], "dlq": dlq.rsplit("/", 1)[1]}
    return cursors.commit(version, _folded(plan.sparkSession, {**state, "cursors": moved, "runs": [*state["runs"], run]}, out))


def _folded(spark: SparkSession, state: dict, out: str) -> dict:
    """The state with a long list of runs moved to a file of its own."""
    if len(state["runs"]) <= RUNS_IN_POINTER:
        return state
    names = spark.createDataFrame([(r["main"], r["dlq"]) for r in state["runs"]], "main string, dlq string")
    path = tables.append_run(names.coalesce(1), f"{out}/published", "runs")
    return {**state, "runs": [], "folded": [*state["folded"], path]}


def _published(spark: SparkSession, out: str, cursors: VersionedPointer, leg: str, ddl: str | None) -> DataFrame:
    _, state = progress(cursors)
    names = [r[leg] for r in state["runs"]]
    if state["folded"]:
        names += [r[0] for r in spark.read.parquet(*state["folded"]).select(leg).collect()]
    paths = [f"{out}/{leg}/{n}" for n in names]
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.parquet(*paths) if paths else spark.createDataFrame([], ddl or "reason string")


def main_records(spark: SparkSession, out: str, cursors: VersionedPointer) -> DataFrame:
    """Records of the ticks that count, each once."""
    return _published(spark, out, cursors, "main", MAIN_DDL)


def dead_records(spark: SparkSession, out: str, cursors: VersionedPointer) -> DataFrame:
    """Letters of the ticks that count."""
    return _published(spark, out, cursors, "dlq", None)
