"""Connected components of a graph in a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge (a, b): the least id that can be reached.

    Every round joins each vertex's neighbours to the least of them, first among all, then among lesser ones; it
    ends when a round changes nothing, after a number of rounds that grows as the logarithm of a component. A
    vertex with very many neighbours is met by aggregates with partial sums, and by joins of two stored tables,
    which Spark splits where they are skewed. Only counts and a checksum come to the driver.
    """
    stars = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")

    def sign(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    known = sign(stars)
    name, other = "stars", "starred"
    while known[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = scratch.save(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        scratch.drop("least", name)
        least = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = scratch.save(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), other)
        scratch.drop("least", "large")
        name, other = other, name
        if (now := sign(stars)) == known:
            break
        known = now
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
