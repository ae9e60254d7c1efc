"""Connected components of an edge table by alternating star contractions.

Large star: every node's larger neighbours are tied to the smallest node that
it sees; small star: a node and its smaller neighbours are tied to the smallest
of them.  Both keep the components, and repeated they leave one star per
component, after a number of rounds that grows with the logarithm of its
size.  A round is two groupings (with map-side combine, so a node with very
many neighbours costs one row per task) and two joins; rounds are written to
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize

ROUNDS = 64


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node that an edge names; the component is
    its smallest node.  ``edges`` has columns a and b of type long."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    e = materialize(spark, e, "edges")
    if e.isEmpty():
        return e.select(F.col("v").alias("node"), F.col("u").alias("component"))
    before = None
    for _ in range(ROUNDS):
        # Large star on both directions of every edge.
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where(F.col("u") > F.col("v")).join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v != u")
        # Small star: (v, u) with u < v.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("x"), "m", "v")
        e = small.select(F.col("x").alias("v"), F.col("m").alias("u")).unionByName(
            small.select("v", F.col("m").alias("u"))).where("v != u").distinct()
        e = materialize(spark, e, "edges")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
