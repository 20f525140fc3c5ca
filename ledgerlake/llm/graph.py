"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import forget, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs); root is the least node reachable.

    Alternates large-star and small-star steps on the edge table until it no longer changes: each
    neighbourhood is reduced to its minimum by a combined aggregate, never gathered, and edges meet
    their minimum by an equi join of stored tables.  About log(n) rounds, each written out.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _content(edges)
    while True:
        large = stored(_star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), large=True), "large")
        last, edges = edges, stored(_star(large, large=False), "small")
        forget(last, large)
        after = _content(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _content(edges: DataFrame) -> tuple:
    """What tells edge tables of successive rounds apart: each round only lowers ends, so equal counts
    and sums mean equal tables."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours are tied to its least neighbour (itself included).
    Small star: a node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = edges.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
