"""Connected components by alternating large and small stars, with contraction inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrete.operators.lookup import balanced_lookup
from accrete.session import staged

_EDGES = "a long, b long"


def joined_to_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a < b) of one task with the same components, one per node: its smallest reachable neighbour.
    For `mapInArrow`; a task that finds edges in Python puts them through here itself, as a second
    `mapInArrow` in its stage would take a second worker process for each task."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while node != top:
            parent[node], node = top, parent.get(node, node)
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for low in range(0, len(nodes), 100_000):
        some = nodes[low : low + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([root(n) for n in some], pa.int64()), pa.array(some, pa.int64())], ["a", "b"])


def contract(edges: DataFrame) -> DataFrame:
    """Edges (a < b) with the same components, at most one per node and task: each task joins its own
    edges to trees and gives each node its smallest reachable neighbour."""
    return edges.select("a", "b").mapInArrow(joined_to_trees, _EDGES)


def _star(edges: DataFrame, centre: str, other: str) -> DataFrame:
    """Edges (smallest neighbour of the centre, neighbour); hot centres are spread."""
    least = staged(edges.groupBy(centre).agg(F.min(other).alias("least"), F.count(F.lit(1)).alias("n")), "least")
    found = balanced_lookup(edges, least, centre, "n")
    return found.withColumn("least", F.least("least", centre))


def components(edges: DataFrame, contracted: bool = False) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge to another one.

    `edges` has long columns a and b in any order, repeats and loops allowed; a null end raises no
    edge. `contracted` says that the tasks joined them to trees (a < b) already. Each round is a few shuffles of the edges left, written to the shared folder, until they
    no longer change; the number of rounds grows with the logarithm of the longest chain.
    """
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current, mark = staged(ordered if contracted else contract(ordered), "edges"), None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, "a", "b").where("b > a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()
        large = staged(large, "large")
        small = _star(large, "b", "a")
        nearer = small.select(F.col("least").alias("a"), F.col("a").alias("b")).where("a <> b")
        own = small.select(F.col("least").alias("a"), "b")
        current = staged(nearer.unionByName(own).distinct(), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        mark = tuple(now)
