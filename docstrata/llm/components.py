"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docstrata.llm.common import settle

#: Every round at least halves the depth of what is left; beyond this the edges are not what they should be.
MOST_ROUNDS = 64


def _nearest(edges: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of it and its neighbours. Written, so that the join deals both sides anew and a hub can be split."""
    return settle(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "nearest")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_nearest(both).hint("merge"), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_nearest(down).hint("merge"), "u").where("v <> least")
    hung = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.unionByName(down.groupBy("u").agg(F.min("v").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, of every node of ``edges (u, v)`` but the roots themselves.

    Nodes are of one ordered type. Loops, repeated edges and nulls at either end are passed over; an empty
    table gives an empty table. Nothing is collected, and a node with very many neighbours is dealt by split joins.
    """
    edges = edges.select("u", "v").where("u <> v").distinct()
    stars, before = settle(edges, "edges"), None
    for _ in range(MOST_ROUNDS):
        stars = settle(_large_star(stars).distinct(), "large-star")
        stars = settle(_small_star(stars).where("u <> v").distinct(), "small-star")
        now = _state(stars)
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
