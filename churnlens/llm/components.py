"""Connected components by contraction, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import staged


def roots(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of ``edges`` (a, b): the smallest vertex it can reach.

    Each pass sends a vertex to the smallest of itself and its neighbours, then to where
    that one goes, and maps the edges to the vertices so reached. Edges within a vertex
    fall away, so a star is done in one pass and a chain of n in about log n. Minima are
    pre-aggregated before the shuffle: a vertex with a third of the edges is no hot task.
    """
    edges = edges.select("a", "b").where(F.col("a") != F.col("b")).distinct()
    known = None
    while True:
        edges = staged(edges, "edges")
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        jump = step.alias("s").join(step.select(F.col("a").alias("p"), F.col("p").alias("q")), "p").select(
            F.col("a").alias("v"), F.col("q").alias("root"))
        jump = staged(jump, "jump")
        to = lambda end: jump.select(F.col("v").alias(end), F.col("root").alias(f"{end}_to"))
        edges = (
            edges.join(to("a"), "a").join(to("b"), "b")
            .select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
            .where(F.col("a") != F.col("b")).distinct()
        )
        known = jump if known is None else staged(_follow(known, jump), "roots")
    return known if known is not None else edges.select(F.col("a").alias("v"), F.col("b").alias("root"))


def _follow(known: DataFrame, step: DataFrame) -> DataFrame:
    nxt = step.select(F.col("v").alias("root"), F.col("root").alias("further"))
    return known.join(nxt, "root", "left").select("v", F.coalesce("further", "root").alias("root"))


def relabel(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (v, c, ...) with c replaced by its root in ``found``."""
    to = found.select(F.col("v").alias("c"), F.col("root"))
    return labels.join(to, "c", "left").withColumn("c", F.coalesce("root", "c")).select(labels.columns)
