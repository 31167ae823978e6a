"""Which rows of a growing shard may be taken, and how far its cursor may move.

Every function works per shard or stream partition by plain aggregates, which combine
before the shuffle; no shard is ever sorted or windowed in one task. Where a bound per shard
is joined back, that small table is written to the work folder when the function is called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchloom.sinks import tables


def stable_prefix(rows: DataFrame, cutoff: int) -> DataFrame:
    """Rows below the first id of their shard that was created after ``cutoff``.

    Ids are given before commit, so a younger id may still be invisible behind a row
    that is too fresh; everything from that row on waits, even if it is older. ``rows`` is
    read twice and must not change in between: of a live source, give a written scan.
    """
    fresh = (
        rows.where(F.col("created_unix") > cutoff)
        .groupBy("shard_table")
        .agg(F.min("id").alias("first_unstable"))
    )
    # one row per shard; written first, so the planner knows the size and need not shuffle the rows
    return (
        rows.join(tables.staged(fresh, "first-unstable"), "shard_table", "left")
        .where(F.col("first_unstable").isNull() | (F.col("id") < F.col("first_unstable")))
        .drop("first_unstable")
    )


def next_cursors(stable: DataFrame) -> DataFrame:
    """Last stable id per shard, whatever became of its rows."""
    return stable.groupBy("shard_table").agg(F.max("id").alias("last_id"))


def advance(current: DataFrame, proposed: DataFrame) -> DataFrame:
    """Cursor table after an advance: a new value at or below the stored one is ignored."""
    return (
        current.select("shard_table", "last_id")
        .unionByName(proposed.select("shard_table", "last_id"))
        .groupBy("shard_table")
        .agg(F.max("last_id").alias("last_id"))
    )


def cursor_lag(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """Highest source id less the cursor, per shard with a cursor."""
    top = rows.groupBy("shard_table").agg(F.max("id").alias("max_id"))
    return cursors.join(top, "shard_table", "left").select(
        "shard_table",
        F.coalesce("max_id", F.lit(0)).alias("source_max_id"),
        "last_id",
        (F.coalesce("max_id", F.lit(0)) - F.col("last_id")).alias("lag"),
    )


def order_violations(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    """First arrival per shard whose id is not above the previous one.

    The rows are range-partitioned by shard and arrival, so a shard spreads over many
    tasks; each slice is checked on its own and the slice borders are compared after,
    one row per shard and slice.
    """
    sliced = rows.select("shard_table", F.col(arrival).alias("arrival"), "id").repartitionByRange(
        "shard_table", "arrival"
    ).withColumn("slice", F.spark_partition_id())
    order = Window.partitionBy("shard_table", "slice").orderBy("arrival")
    inside = sliced.withColumn("prev_id", F.lag("id").over(order))
    bad = F.when(F.col("id") <= F.col("prev_id"), F.struct("arrival", "prev_id", "id"))
    per_slice = inside.groupBy("shard_table", "slice").agg(
        F.min(bad).alias("bad"),
        F.min(F.struct("arrival", "id")).alias("first"),
        F.max(F.struct("arrival", "id")).alias("last"),
    )
    # as many rows as there are shuffle partitions and shards
    borders = Window.partitionBy("shard_table").orderBy("first.arrival")
    joined = per_slice.withColumn("before", F.lag("last").over(borders))
    border_bad = F.when(
        F.col("first.id") <= F.col("before.id"),
        F.struct(
            F.col("first.arrival").alias("arrival"),
            F.col("before.id").alias("prev_id"),
            F.col("first.id").alias("id"),
        ),
    )
    return (
        joined.groupBy("shard_table")
        .agg(F.min(F.least(border_bad, F.col("bad"))).alias("v"))
        .where(F.col("v").isNotNull())
        .select("shard_table", "v.arrival", "v.prev_id", "v.id")
    )


def commit_points(items: DataFrame) -> DataFrame:
    """Per stream partition the last offset before the first transient item.

    ``items`` has topic, partition, offset, disposition. A partition whose head is
    transient yields no row.
    """
    transient = F.col("disposition") == "transient"
    stops = items.groupBy("topic", "partition").agg(
        F.min(F.when(transient, F.col("offset"))).alias("first_transient")
    )
    # one row per stream partition; written first, so the planner knows the size and need not
    # gather a crowded partition in one task
    return (
        items.join(tables.staged(stops, "first-transient"), ["topic", "partition"])
        .where(F.col("first_transient").isNull() | (F.col("offset") < F.col("first_transient")))
        .groupBy("topic", "partition")
        .agg(F.max("offset").alias("commit_offset"))
    )


def drained(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Whether the commits have reached the log end on every partition.

    ``ends`` has topic, partition, end_offset (next offset to be written); ``committed``
    has topic, partition, commit_offset (last offset done).
    """
    return (
        ends.join(committed, ["topic", "partition"], "left")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.sum(F.greatest(F.col("end_offset") - 1 - F.coalesce("commit_offset", F.lit(-1)), F.lit(0))).alias(
                "open_items"
            ),
            F.bool_and(F.coalesce(F.col("commit_offset") + 1 >= F.col("end_offset"), F.col("end_offset") == 0)).alias(
                "drained"
            ),
        )
    )
