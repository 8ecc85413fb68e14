"""Distributed connected components with DataFrame operations only.

Each round hooks every node to its smallest neighbour, compresses the resulting
forest by pointer jumping and contracts the edges; the number of rounds grows
with the logarithm of the largest component.  Nothing but row counts reaches
the driver.  Joins look up a table with one row per node, so a hub with very
many edges is a skewed but splittable side of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Map nodes that have an edge to the smallest node they reach.

    edges: columns ``src`` and ``dst`` (any orderable type, same for both).
    Returns ``node``, ``component``: one row per node that has an edge to
    another node, except the smallest of each component, which a caller adds by
    ``coalesce(component, node)``.  Null ends, loops and repeated edges have no
    effect; no edges give an empty table.
    """
    e = scratch.cut(_oriented(edges), "edges")
    mapping = None
    while not e.isEmpty():
        parent = scratch.cut(e.groupBy("a").agg(F.min("b").alias("p")), "hook")
        parent = _compress(parent, scratch)
        if mapping is None:
            mapping = parent
        else:
            moved = mapping.join(
                parent.select(F.col("a").alias("_a"), F.col("p").alias("_p")),
                F.col("p") == F.col("_a"), "left",
            ).select("a", F.coalesce("_p", "p").alias("p"))
            old = mapping
            mapping = scratch.cut(moved.unionByName(parent), "mapping")
            scratch.drop(old)
        root = parent.select(F.col("a").alias("_a"), F.col("p").alias("_p"))
        heads = e.join(root, F.col("a") == F.col("_a"), "left").select(
            F.coalesce("_p", "a").alias("src"), "b")
        both = heads.join(root, F.col("b") == F.col("_a"), "left").select(
            "src", F.coalesce("_p", "b").alias("dst"))
        contracted = scratch.cut(_oriented(both), "edges")
        scratch.drop(e)
        e = contracted
    if mapping is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return mapping.select(F.col("a").alias("node"), F.col("p").alias("component"))


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct()
    )


def _compress(parent: DataFrame, scratch: Scratch) -> DataFrame:
    """Point every node of the forest straight at its root."""
    while True:
        up = parent.select(F.col("a").alias("_a"), F.col("p").alias("_p"))
        moving = parent.join(up, F.col("p") == F.col("_a"), "left_semi")
        if moving.isEmpty():
            return parent
        jumped = scratch.cut(
            parent.join(up, F.col("p") == F.col("_a"), "left").select(
                "a", F.coalesce("_p", "p").alias("p")),
            "jump",
        )
        scratch.drop(parent)
        parent = jumped
