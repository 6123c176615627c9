"""Connected components of a graph given by its edges, without collecting any."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import cut, ship, size_mb


TASK_MB = 4.0  # of written edges that one task joins: under a million


class UnionFind:
    """Sets over any hashable nodes; the smallest node leads its set."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x] = root
            x = p
        return root

    def union(self, a, b) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars."""
    sets = UnionFind()
    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            sets.union(x, y)
    nodes = list(sets.up)
    for i in range(0, len(nodes), 50_000):
        own = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([sets.find(x) for x in own], pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): the smallest node that is reachable; of nodes that have an edge to another.

    Each partition's edges become stars first, and once more when dealt to tasks of
    `TASK_MB`; where one task held them all, that is the result. Else large-star
    and small-star steps follow in turn until nothing changes, which takes about
    log(n) rounds. The sides that are joined are both written tables, so that the
    engine can split a hub's rows.
    """
    ship(edges.sparkSession)
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = cut(e.mapInArrow(_forest, "a long, b long").where("a != b").distinct(), "edges")
    tasks = int(size_mb(e) / TASK_MB) + 1
    e = cut(e.repartition(tasks).mapInArrow(_forest, "a long, b long").where("a != b"), "edges")
    state = None
    while True:
        new = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() if tasks > 1 else state
        if new == state or not new[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state = new
        # large star: every neighbour above u goes to u's least neighbour (or u)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = cut(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(), "large")
        # small star: u and its lesser neighbours go to the least of these
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")

