"""Connected components by alternating large and small stars.

Every round is two aggregations and two joins, so nothing meets on the driver. A star's rows are
joined by its centre: Spark splits a large one as a skewed join (`spark.sql.adaptive.skewJoin`, on by
default); with that off a large component's rows would meet in one task. Rounds are written to the
shared folder, and read back in as many partitions as their rows are worth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized, staged_with


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable. edges (a, b) of longs; loops and repeats don't matter."""
    now = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    mark, first = None, True
    while True:
        now, seen = staged_with(now.distinct() if first else now, "edges", sum=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
        first, now = False, sized(now, seen["rows"])
        if not seen["rows"] or seen == mark:
            break
        mark = seen
        now = _small_star(_large_star(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
