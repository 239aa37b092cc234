"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safetylake.session import stage_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to its larger (large star) or smaller neighbours."""
    if large:
        ends = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ends.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    met = ends.join(least, "u")
    if large:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, component): the smallest node reachable, for every node of an edge.

    Every round is written to the shared folder; what comes to the driver is one count and one sum a round.
    The number of rounds grows with the logarithm of the number of nodes.
    """
    at = stage_table(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        at = stage_table(_star(_star(at, True), False), "stars")
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = at.select(F.col("v").alias("u")).distinct()
    return at.select("u", F.col("v").alias("component")).unionByName(roots.select("u", F.col("u").alias("component")))
