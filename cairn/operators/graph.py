"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.sources.shared import written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component``: the smallest node that each node of an edge reaches.

    Each round links every node's larger neighbours to its smallest one, then its
    smaller ones likewise, until nothing changes: the rounds grow with the logarithm
    of the size of a component, not with its diameter.  A node with very many edges
    is aggregated to its smallest neighbour first, and that one row meets its edges
    in a join that Spark can split.  Loops and null ends have no effect.
    """
    e = written(_larger_first(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    state = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = written(_star(both, larger=True), "star")
        e = written(_star(e, larger=False), "star")
        now = _state(e)
        if now == state:
            top = e.select(F.col("v").alias("node")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(top.select("node", F.col("node").alias("component")))
        state = now


def _larger_first(e: DataFrame) -> DataFrame:
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _star(e: DataFrame, larger: bool) -> DataFrame:
    """Neighbours of u (larger ones, or the smaller ones and u itself) linked to the smallest of u and its neighbours."""
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    met = e.join(least.hint("merge"), F.col("u") == F.col("c"))  # grows with the rows: never sent whole
    if larger:
        return _larger_first(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    smaller = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _larger_first(smaller.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))))


def _state(e: DataFrame) -> tuple[int, int]:
    row = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF)), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]
