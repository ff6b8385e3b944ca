"""Connected components by alternating large and small stars; all state stays in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).where("lo < hi").distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether every upper end has one edge and is no lower end."""
    ends = edges.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("lo").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """For edges (x, y) of longs: node and component (its smallest node), for all nodes but the
    smallest of each component. Rounds grow with the logarithm of the largest component."""
    edges = durable(_ordered(edges), "edges")
    while not _is_star(edges):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.join(least, edges["lo"] == least["u"]).select(F.col("m").alias("lo"), "hi").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("x"), F.col("m").alias("y")).unionByName(low.select(F.col("hi").alias("x"), F.col("m").alias("y")))
        edges = durable(_ordered(small), "edges")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
