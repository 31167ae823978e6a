"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.sinks.tables import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of itself and its neighbours to the neighbours larger than itself."""
    both = edges.select("u", "v").union(edges.select("v", "u")).distinct()
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest of its smaller neighbours to itself and to the others of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): for each node with a link to another node, the smallest node it can reach.

    Null ends and links of a node with itself are left out; repeated links and either direction
    are alike. Each round is written to the shared folder, and rounds end when none changes a
    link. A node of many links takes part in sums and joins only, which the planner can split.
    """
    links = links.select(F.col(u).alias("u"), F.col(v).alias("v"))
    stars = staged(_small_star(links.where(F.col("u").isNotNull() & F.col("v").isNotNull())), "stars")
    seen = None
    while True:
        mark = tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == seen:
            # every link now leads from a node to the smallest of its component
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
        seen = mark
        stars = staged(_small_star(_large_star(stars)), "stars")
