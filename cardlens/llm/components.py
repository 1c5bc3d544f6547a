"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is joins and aggregations over edges; each round's edges are written to
the shared folder, so lineage stays short and a lost executor costs one step. No
component is ever brought together in one task: a node with many neighbours
only meets them as rows of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))) \
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component for every node of ``edges`` (two bigint columns a, b);
    roots themselves are included. The loop ends when a round changes no edge."""
    edges = write_shared(edges.select("a", "b").filter(F.col("a") != F.col("b")), "edges")
    state = _state(edges)
    while state[0]:
        edges = write_shared(_small_star(_large_star(edges)), "edges")
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
