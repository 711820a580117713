"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than the node moves to the smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour smaller than the node, and the node, move to the smallest one."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).cast("string")
    ).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``links (a, b)``; the component is its smallest node.

    Both columns are longs. Links of a node to itself add nothing; an empty table
    gives an empty result. Each round is written to the shared folder, and only a
    count and a checksum reach the driver. Minima are taken by partial aggregation,
    so a node with very many links does not gather in one task.
    """
    current = written(links.select("a", "b").where("a <> b").distinct())
    state = _state(current)
    while True:
        current = written(_small_star(_large_star(current)))
        before, state = state, _state(current)
        if before == state:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
