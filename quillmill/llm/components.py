"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillmill.llm.scratch import Scratch


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, label) of every node that has an edge to another; label is the least id of its component.

    edges has two columns of integers, u and v. Loops and repeated edges change nothing; rows with a null are left
    out; no edge gives an empty table. Each round is written to the shared folder and takes two joins on node ids, and
    their number grows with the logarithm of the longest path.
    """
    current = scratch.write(edges.where("u <> v").distinct(), "edges0")
    before, k = None, 0
    while True:
        k += 1
        current = scratch.write(_small_star(_large_star(current)), f"edges{k}")
        scratch.drop(f"edges{k - 1}")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    stars = current.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return stars.unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
