"""Connected components of a graph given as rows (a, b): stars are drawn to the smallest neighbour until nothing changes.

Every round is a grouping with partial minima and a join, so a vertex with very many neighbours is no single group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, root): every vertex of an edge with the smallest vertex it is connected to. Loops and null ends are left out."""
    edges = stored(edges.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        # each half of a round is written, so the driver never plans a half twice
        ends = edges.selectExpr("inline(array(struct(a, b), struct(b as a, a as b)))")
        least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        low = stored(edges.selectExpr("b as a", "a as b").join(least, "a").selectExpr("b as a", "m as b").distinct(), "edges")
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = low.join(least, "a").where("b <> m").selectExpr("b as a", "m as b").unionByName(least.selectExpr("a", "m as b"))
        edges = stored(small.distinct(), "edges")
    stars = edges.groupBy("a").agg(F.min("b").alias("b"))
    return stars.selectExpr("a as id", "b as root").unionByName(stars.selectExpr("b as id", "b as root").distinct())
