"""Connected components of an edge table by alternating star contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import materialize

MOST_ROUNDS = 60
#: Parts in which a node's edges meet its least neighbour, so that a node with very many edges is not one task.
SALTS = 16


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link each larger neighbour to the least neighbour. Small star: each smaller neighbour and the node itself."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"])
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge downwards or only edges upwards."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long, no nulls): root is the least node that can be reached.

    Each round halves the depth of the trees at least; it ends when the edges are stars. A round's edges go to the shared checkpoint
    folder, so lineage stays short and a lost executor costs one round at most.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(MOST_ROUNDS):
        if _are_stars(now):
            break
        now = materialize(_star(_star(now, True), False))
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
