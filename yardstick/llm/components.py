"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a partial aggregate and a join; nothing is collected but one row per round.
Each round's edges are a written table, and the round before is deleted.  The rounds end when
every node hangs on one smaller node that hangs on none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a > b).  Large star: larger neighbours go to the smallest neighbour or self.
    Small star: smaller neighbours and self go to the smallest neighbour."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))  # the small star drops repeats
    else:
        out = linked.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is nowhere a smaller end."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up")), F.struct(F.col("b").alias("x"), F.lit(0).alias("up")))).alias("e"))
    roles = ends.groupBy("e.x").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return not roles.agg(F.max(F.expr("up > 1 or (up = 1 and least = 0)"))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the edges; label is the smallest node reachable."""
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    if edges.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    before = None
    while True:
        now = written(_star(_star(now, True), False), "components")
        if before is not None:
            discard(before)
        if _stars(now):
            break
        before = now
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
