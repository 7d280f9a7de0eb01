"""Connected components of a graph given as edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % 1_000_003)), F.sum(F.xxhash64("b") % 999_983)).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge of `edges` (a, b: bigint); root: the smallest node of its component.

    After Kiveris et al. (2014). Each step is an aggregation (combined before the shuffle) and a
    join that adaptive execution splits where a node has very many edges; each is written to the
    shared folder, so a lost executor costs a re-read. No component is ever in one task.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        # Large star: neighbours above a node hang on the smallest of all its neighbours.
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Small star: a node and its lower neighbours hang on the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = stage(small.where("a <> b").distinct(), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return (
        roots.select(F.col("a").alias("node"), "root")
        .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
               .join(roots.select(F.col("a").alias("node")), "node", "left_anti"))
    )
