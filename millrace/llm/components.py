"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node with its smallest neighbour or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours with the smallest of them (here v < u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; root is the smallest reachable.

    Edges may repeat, run either way and link a node with itself; those with a null are
    left out. A node whose only edge is to itself is not returned. Each round is written
    to the shared folder, so a lost executor costs no more than the round.
    """
    held = edges.where("u is not null and v is not null and u <> v")
    held = held.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        held = written(_small_star(_large_star(held)), "components")
        now = _state(held)
        if now == before or not now[0]:
            break
        before = now
    roots = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
