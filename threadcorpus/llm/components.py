"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.session import materialize


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


# A node with more than this many edges, or more than one edge in so many, is a hot centre. There are at most twice
# HOT_SHARE of them, whatever the table's size. A centre's edges are dealt over so many keys.
HOT_EDGES, HOT_SHARE, HOT_PARTS = 500, 500, 64


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Join each node's larger neighbours to the least node around it; edges of a hot centre are dealt by their other end."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")))
    hot = F.col("n") > max(HOT_EDGES, n_edges // HOT_SHARE)
    parts = F.explode(F.when(hot, F.array(*map(F.lit, range(HOT_PARTS)))).otherwise(F.array(F.lit(0)))).alias("part")
    centres = F.broadcast(least.where(hot).select("u", F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(HOT_PARTS))).otherwise(F.lit(0)).cast("int").alias("part")
    larger = both.where("v > u").join(centres, "u", "left").select("u", "v", part)
    return larger.join(least.select("u", "m", parts), ["u", "part"]).where("v <> m") \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join each node and its smaller neighbours to the least of them."""
    least = _minimum(edges)
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its least node.

    Each round is written to the shared folder, so lineage stays short. Rounds
    end when the edges no longer change, after a number of rounds that grows
    with the logarithm of the number of nodes.
    """
    tidy = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = materialize(tidy)
    before, n_edges = None, current.count()
    while True:
        current = materialize(_small_star(_large_star(current, n_edges)))
        state = current.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if tuple(state) == before:
            break
        before, n_edges = tuple(state), state[0]
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
