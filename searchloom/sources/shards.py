"""Message shards from parquet folders or over JDBC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.operators import gates


def read_parquet(spark: SparkSession, root: str) -> DataFrame:
    """All shards below ``root/shard_table=<name>/`` as one scan."""
    return spark.read.schema(C.ddl(C.ROW_FIELDS)).option("basePath", root).parquet(root)


def read_jdbc(
    spark: SparkSession, url: str, cursors: dict[str, int], tops: dict[str, int], partitions: int, properties: dict
) -> DataFrame:
    """Shard tables over JDBC, each split by id between its cursor and its highest id."""
    gates.require_shard_names(list(cursors))
    columns = ", ".join("`signal`" if n == "signal" else n for n, _ in C.ROW_FIELDS[1:] if n != "created_unix")
    frames = []
    for shard, last in cursors.items():
        query = f"(SELECT {columns}, UNIX_TIMESTAMP(created_at) AS created_unix FROM `{shard}` WHERE id > {int(last)}) t"
        rows = spark.read.jdbc(
            url, query, column="id", lowerBound=last, upperBound=max(tops[shard], last + 1),
            numPartitions=partitions, properties=properties,
        )
        frames.append(rows.select(F.lit(shard).alias("shard_table"), "*"))
    return reduce(DataFrame.unionByName, frames)


def above_cursors(cursors: dict[str, int]) -> Column:
    """Rows above the cursor of their shard, as a plain predicate the scan can use.

    Shards without a cursor start at 0. The cursor table has one row per shard.
    """
    shard, id_ = F.col("shard_table"), F.col("id")
    known = [(shard == s) & (id_ > last) for s, last in sorted(cursors.items())]
    unknown = id_ > 0 if not cursors else ~shard.isin(sorted(cursors)) & (id_ > 0)
    return reduce(lambda a, b: a | b, known, unknown)


def scan(rows: DataFrame, cursors: dict[str, int]) -> DataFrame:
    """The fixed columns of all rows above their cursor."""
    return rows.where(above_cursors(cursors)).select(*[n for n, _ in C.ROW_FIELDS])


def scan_between(rows: DataFrame, cursors: dict[str, int], upto: dict[str, int]) -> DataFrame:
    """The fixed columns of the rows above their cursor and not above ``upto``; of the shards in ``upto`` only."""
    shard, id_ = F.col("shard_table"), F.col("id")
    ranges = [(shard == s) & (id_ > cursors.get(s, 0)) & (id_ <= end) for s, end in sorted(upto.items())]
    return rows.where(reduce(lambda a, b: a | b, ranges, F.lit(False))).select(*[n for n, _ in C.ROW_FIELDS])
