"""Connected components of a large graph, without collecting any group of nodes or links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from remarklab.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).head()
    return row["n"], row["s"]


def _star(pairs: DataFrame) -> DataFrame:
    """Link every neighbour of u, and u, to the smallest of them; ``pairs`` are (u, v)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for all nodes of the links in columns ``u`` and ``v`` of any orderable type.

    The component is its smallest node. Links to oneself, repeated and NULL links add nothing; no links
    give no rows. Each round links larger neighbours of a node, then smaller ones, to the smallest of
    all; the number of rounds grows with the logarithm of a component's size. Minima are aggregates, so
    a node with very many links is combined on the map side. Every round is written to the shared
    checkpoint folder.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    if before[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # now every link points to a smaller node; link the smaller neighbours and the node itself
        small = _star(large)
        edges = cut(small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        after = _state(edges)
        if after == before:
            # stars: every node but the centre has one link, to the smallest
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = after
    raise RuntimeError(f"no fixed point after {rounds} rounds")
