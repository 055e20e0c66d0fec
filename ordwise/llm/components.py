"""Connected components of a link table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node reachable) for every node of ``links``
    (``a, b``, longs). Alternates large-star and small-star steps until
    nothing changes; every round is written to the shared folder. Minima are
    aggregated partially, so a node with very many links costs no task more
    than its share. Null ends and loops are ignored; no links give no rows."""
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = materialize(edges, "components"), None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        # large star: link every larger neighbour to the smallest node around
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "components")
        # small star: link a node and its smaller neighbours to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where(F.col("u") != F.col("v")).distinct()
        old, edges = edges, materialize(small, "components")
        release(old, large)
