"""Connected components by contraction, on Spark tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``edges`` (two integer columns ``a, b``).

    Every node points to its smallest neighbour if that is smaller; pointers are
    doubled twice, the edges are rewritten to the ends of the pointers, and loops
    and repetitions go. Components shrink to their smallest node in few rounds.
    Rounds are cut by written tables. Joins meet hot nodes on one side only, so a
    skewed one can be split.
    """
    left = staged(_oriented(edges.select("a", "b")), "component-edges")
    found = None
    while not left.isEmpty():
        parent = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        for _ in range(2):
            further = parent.select(F.col("node").alias("at"), F.col("parent").alias("next"))
            parent = parent.join(further, F.col("parent") == F.col("at"), "left").select("node", F.coalesce("next", "parent").alias("parent"))
        parent = staged(parent, "component-parents")
        first = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        second = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = left.join(first, "a", "left").join(second, "b", "left")
        left = staged(_oriented(moved.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))), "component-edges")
        if found is None:
            found = parent
        else:
            later = parent.select(F.col("node").alias("at"), F.col("parent").alias("next"))
            ends = found.join(later, F.col("parent") == F.col("at"), "left").select("node", F.coalesce("next", "parent").alias("parent"))
            fresh = parent.join(found.select("node"), "node", "left_anti")
            found = staged(ends.unionByName(fresh), "component-ends")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    roots = found.select(F.col("parent").alias("node")).distinct().join(found.select("node"), "node", "left_anti")
    return found.select("node", F.col("parent").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once, no loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


class Forest:
    """Union-find of the links one task sees; gives one edge per node that is not a root."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        path = []
        while (up := self.above.get(node, node)) != node:
            path.append(node)
            node = up
        for p in path:
            self.above[p] = node
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(node, self.root(node)) for node in self.above]
