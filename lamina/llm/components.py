"""Connected components of an edge table, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators.joins import DEFAULT_SKEW, lookup_join
from lamina.runtime import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of an edge.

    Large-star and small-star steps in turn: every node links its larger neighbours to its smallest,
    then itself and its smaller ones, until the edges are stars around the smallest nodes. Each step
    keeps connectivity, never has more edges than nodes and edges before, and combines by minimum
    before it shuffles. Long chains shrink geometrically; a table that is not done after ``rounds``
    rounds raises an error instead of giving part of the answer. Loops and repeated edges are
    allowed, edges with a null end are left out, and no edges give no rows.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = materialize(pairs.distinct(), "component-edges")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    links, before = pairs.where("u != v"), None
    small = links.count() <= DEFAULT_SKEW.broadcast_rows  # edges never become more
    for _ in range(rounds):
        if small:
            links = materialize(_small_star(_large_star(links, True), True), "component-edges")
        else:
            links = materialize(_large_star(links, False), "component-edges")
            links = materialize(_small_star(links, False), "component-edges")
        # Stars around the smallest nodes do not change any more.
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.join(roots, "node", "left").select(
                "node", F.coalesce("root", "node").alias("root")
            )
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _beside(links: DataFrame, least: DataFrame, on: str, how: str, small: bool) -> DataFrame:
    """Edges with the one row of their node on one side: broadcast where edges are few, else the edges of hot nodes
    are spread over several tasks."""
    if small:
        return links.join(F.broadcast(least), on, how)
    return lookup_join(links, least, [on], how, right_is_large=True)


def _large_star(links: DataFrame, small: bool) -> DataFrame:
    """Every node's larger neighbours, linked to the smallest node among itself and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    # Larger neighbours of x are the u of edges (u, x); x's smallest is its least v, or x itself.
    joined = _beside(links, least.select(F.col("u").alias("v"), "m"), "v", "left", small)
    return joined.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(links: DataFrame, small: bool) -> DataFrame:
    """Every node and its smaller neighbours, linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = _beside(links, least, "u", "inner", small).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
