"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets linked to the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, get linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def state_of(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (u, v) except roots; the root is the least id of its component.

    Each round is written to the shared folder, so lineage stays short and the
    edge table never exceeds its first size. Loops and repeated edges are
    ignored; no edges give no rows.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state_of(edges)
    while before[0]:
        edges = stored(small_star(large_star(edges)), "edges")
        after = state_of(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
