"""Subtree totals of large forests by parallel tree contraction in join rounds.

Rounds alternate. *Rake* takes every leaf away and adds its total to its parent.
*Compress* takes nodes with one child out of their chain; the child is tied to
the grandparent and from then on also carries what the removed node held. Of two
neighbours in a chain at most one is removed in a round, as bits of ``level``
tell: with levels that count depth, a chain halves in each round. So rounds grow
with the logarithm of the tree's depth and size, whatever its shape. Each
removed node remembers its child and what to add; going back over the rounds,
the child's total is known and gives the node's own.

Children are counted and leaves summed by partial aggregation before they meet
their parent, so a node with very many children is one row in every join. Each
round is a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import stored

LEVEL_BITS = 32


def with_children(live: DataFrame) -> DataFrame:
    """``live`` with the number of children and one of them."""
    children = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("_of")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("child")
    )
    return live.join(children, F.col("id") == F.col("_of"), "left").drop("_of")


def rake(live: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(totals of the leaves taken away, nodes that are left)."""
    marked = stored(with_children(live), "rake")
    leaves = marked.filter("n IS NULL AND parent IS NOT NULL")
    given = leaves.groupBy(F.col("parent").alias("_of")).agg(*[F.sum(F.col(v) + F.col(f"up_{v}")).alias(f"_{v}") for v in values])
    rest = marked.filter("n IS NOT NULL OR parent IS NULL").join(given, F.col("id") == F.col("_of"), "left")
    added = [(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]
    rest = rest.select("id", "parent", "level", *added, *[f"up_{v}" for v in values])
    return leaves.select("id", *values), stored(rest, "live")


def compress(live: DataFrame, values: Sequence[str], bit: int) -> tuple[DataFrame, DataFrame]:
    """(id, child, and what a removed node has beyond its child's total; nodes that are left)."""
    marked = stored(with_children(live), "compress")
    turn = F.col("parent").isNotNull() & (F.col("n") == 1) & (F.shiftright("level", bit).bitwiseAND(1) == 1)
    below = marked.select(F.col("id").alias("_id"), F.coalesce(turn, F.lit(False)).alias("_turn"), *[F.col(f"up_{v}").alias(f"_up_{v}") for v in values])
    taken = marked.filter(turn).join(below, F.col("child") == F.col("_id")).filter("NOT _turn")
    taken = stored(
        taken.select(
            "id", "child", "parent",
            *[(F.col(v) + F.col(f"_up_{v}")).alias(f"more_{v}") for v in values],
            *[(F.col(v) + F.col(f"_up_{v}") + F.col(f"up_{v}")).alias(f"to_{v}") for v in values],
        ),
        "taken",
    )
    moved = taken.select(F.col("child").alias("_child"), F.col("parent").alias("_parent"), *[f"to_{v}" for v in values])
    rest = marked.join(taken.select(F.col("id").alias("_gone")), F.col("id") == F.col("_gone"), "left_anti")
    rest = rest.join(moved, F.col("id") == F.col("_child"), "left").select(
        "id", F.coalesce("_parent", "parent").alias("parent"), "level", *values,
        *[F.coalesce(f"to_{v}", f"up_{v}").alias(f"up_{v}") for v in values],
    )
    return taken.select("id", "child", *[f"more_{v}" for v in values]), stored(rest, "live")


def subtree_totals(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, one total over the node's subtree for each of ``values``) of a forest (id, parent, level, values).

    ``id`` is unique and of any type that sorts, roots have no parent, parents
    are nodes, and a child's ``level`` differs from its parent's (depths will
    do). No nodes give no rows.
    """
    held = [F.col(v).cast("long").alias(v) for v in values]
    live = stored(nodes.select("id", "parent", "level", *held, *[F.lit(0).cast("long").alias(f"up_{v}") for v in values]), "live")
    bits = live.agg(F.max("level")).first()[0]
    bits = min(max(int(bits or 0).bit_length(), 1), LEVEL_BITS)
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not live.filter("parent IS NOT NULL").isEmpty():
        leaves, live = rake(live, values)
        taken, live = compress(live, values, len(rounds) % bits)
        rounds.append((leaves, taken))
    known = [live.select("id", *values)]  # the roots
    for leaves, taken in reversed(rounds):
        # Whatever was removed later is known; a child has one parent, so both sides of the join are unique.
        later = reduce(DataFrame.union, known).select(F.col("id").alias("_id"), *[F.col(v).alias(f"_{v}") for v in values])
        found = taken.join(later, F.col("child") == F.col("_id"))
        known.append(stored(found.select("id", *[(F.col(f"_{v}") + F.col(f"more_{v}")).alias(v) for v in values]), "totals"))
        known.append(leaves)
    return reduce(DataFrame.union, known)
