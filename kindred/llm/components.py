"""Connected components of an edge table, by large-star and small-star rounds (Kiveris and others, 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import settle

MAX_ROUNDS = 60
#: So many edges, 8 MB, are few enough for one task; more are joined in rounds.
FEW_EDGES = 500_000


def _star(edges: DataFrame) -> DataFrame:
    """Point each end of a node's edges at the smallest of them. edges: u, v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def _in_one_task(edges: DataFrame) -> DataFrame:
    """The same by union-find, for a number of edges that is known to be small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = root[x]
            return x

        for batch in batches:
            for u, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = find(u), find(v)
                root[max(a, b)] = min(a, b)
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["node", "root"])

    return edges.repartition(1).mapInArrow(run, "node long, root long")


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Returns node, root for every node that has an edge; the root is the component's smallest node.

    At most FEW_EDGES edges are joined by one task. With more, each round is two equi-joins whose hot side adaptive execution can split, and is written to the
    shared folder, so that the lineage stays short. Rounds grow with the logarithm of the nodes.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = settle(edges, "edges")
    before = _print(edges)
    if before[0] <= FEW_EDGES:
        return settle(_in_one_task(edges), "roots")
    for _ in range(MAX_ROUNDS):
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(around).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large)
        down = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = settle(down.where("u <> v").distinct(), "edges")
        after = _print(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components didn't settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return settle(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
