"""Connected components of an edge table, by contraction; edges and nodes stay distributed."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import dropped, tidied, written

#: Edges at most that one task contracts to the end: some 50 MB of its worker process.
LAST_EDGES = 200_000


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its part) for all nodes of some edges but the smallest ones."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    return np.array(nodes, np.int64), np.array([find(x) for x in nodes], np.int64)


def _local_forest(frames):
    parts = [(np.asarray(f.column(0)), np.asarray(f.column(1))) for f in frames if f.num_rows]
    if parts:
        node, root = spanning(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])


def _last_forest(frames):
    """(node, up) of all nodes of some edges, the smallest ones included."""
    for b in _local_forest(frames):
        roots = np.unique(np.asarray(b.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.asarray(b.column(0)), roots])), pa.array(np.concatenate([np.asarray(b.column(1)), roots]))], names=["node", "up"])


def reduced(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, at most one for each node of a partition: what groups of many links shrink to before a shuffle."""
    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").mapInArrow(_local_forest, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of edges (a, b) with the smallest node of its component.

    Each round points every node to its smallest neighbour or itself, follows the pointers twice, contracts the edges along them and
    drops what has become a loop. A table is written after each round; a round at least halves what is left of a component's nodes. When no more than
    `LAST_EDGES` edges are left, one task contracts them to the end.
    Null ends and loops are no edges. Nodes are 64-bit integers.
    """
    edges = written(reduced(edges), "edges")
    labels, used = None, [edges]
    while left := edges.count():
        if last := left <= LAST_EDGES:
            up = written(edges.coalesce(1).mapInArrow(tidied(_last_forest), "node long, up long"), "pointers")
        else:
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            up = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")).select(F.col("a").alias("node"), "up")
            up = written(up, "pointers")
            used.append(up)
            for _ in range(2):
                further = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
                up = up.join(further, "up").select("node", F.col("further").alias("up"))
            up = written(up, "pointers")
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))  # read from its pointers
        else:
            moved = up.select(F.col("node").alias("component"), "up")
            labels = written(labels.join(moved, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "labels")
            used.append(up)
        if last:
            break
        for end in ("a", "b"):
            edges = edges.join(up.select(F.col("node").alias(end), F.col("up").alias("_to")), end).drop(end).withColumnRenamed("_to", end)
        edges = written(reduced(edges), "edges")
        used.append(edges)
    spark = edges.sparkSession
    dropped(*used)
    return labels if labels is not None else spark.createDataFrame([], "node long, component long")
