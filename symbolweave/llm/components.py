"""Connected components of a graph given as edges, by alternating star contractions on DataFrames."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from symbolweave.llm.common import discard, stored

MAX_ROUNDS = 60


def components(edges: DataFrame, tidy: bool = False) -> DataFrame:
    """``(node, component)`` for each node of ``edges(a, b)``; the component is its smallest node.

    Each round joins the edges with one minimum per node, so a node with very many neighbours is pre-aggregated
    and its join can be split; no neighbour list is gathered. Rounds end when no edge changes. Edges with a null
    end are left out, loops keep their node, repeated edges count once, and no edges give no rows. ``tidy`` removes
    the table of each round when the next one is written.
    """
    whole = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    links = stored(whole.where("a < b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        old, links = links, stored(_small_star(_large_star(links)), "links")
        if tidy:
            discard(old)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Every edge now points from a node to the smallest of its component.
    own = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    alone = loops.select("node", F.col("node").alias("component"))
    return own.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))


def _large_star(links: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it; ``links(a < b)``."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u")
        .select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Ties the smaller neighbours of a node, and the node, to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    tied = links.join(least, "b").where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return tied.union(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
