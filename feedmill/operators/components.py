"""Connected components of a graph given as edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.session import drop_staged, stage


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b), component its smallest node.

    Alternates two steps until nothing changes. The large step links every larger
    neighbour of a node to the smallest node of its neighbourhood, the small step
    does so for the smaller neighbours. Both keep the components and turn each
    into a star around its smallest node. The smallest neighbour is a combinable
    minimum, so a node with very many neighbours is one row per task in that
    shuffle; the join after it is one that skew handling can split. Each round
    writes a table, so lineage stays short and lost executors cost one round.
    """
    edges = stage(_distinct_edges(edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )), "edges")
    while True:
        before = edges
        both = before.unionAll(before.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        large = _distinct_edges(
            both.where(F.col("b") > F.col("a")).join(lowest, F.col("a") == F.col("n"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(smallest, F.col("a") == F.col("n")).select(
            F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
            )).alias("e")
        ).select("e.*")
        edges = stage(_distinct_edges(small), "edges")
        changed = edges.join(before, ["a", "b"], "left_anti").limit(1).count() + (edges.count() != before.count())
        drop_staged(before)
        if not changed:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
