"""Connected components of a graph given by its links, by alternating star contractions.

Each round hangs the neighbours of every node on the smallest node near it, once towards the larger and
once towards the smaller neighbours; the links shrink to one star a component in about log(diameter) rounds. Minima
are taken with partial aggregation, staged, and joined back, so that the join is one of two plain exchanges and Spark's skew
join splits a node with very many links; only two numbers a round reach the driver. The links are staged each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _sum_of(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staged(down.groupBy("a").agg(F.min("b").alias("m")))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: two columns of one orderable type. Returns node, root: the smallest node of its component, for each node
    that has a link to another one. Null ends and loops are ignored; no links give no rows."""
    a, b = links.columns
    now = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    now, seen = staged(now), None
    while (found := _sum_of(now)) != seen:
        seen = found
        now = staged(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
