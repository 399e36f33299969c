"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, tidy


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges, and for each the least node that these edges join it to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))  # a root is hung below a smaller one only
        while not np.array_equal(up := root[root], root):
            root = up
        x, y = root[x], root[y]
        apart = x != y
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def contracted(edges: DataFrame, block: int) -> DataFrame:
    """Edges (a, b) that join the same nodes: each block of a partition's edges as stars round its components' least nodes."""

    @tidy
    def run(batches):
        held, size = [], 0

        def given_out():
            a, b = stars(*(np.concatenate(side) for side in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if len(batch):
                held.append(tuple(batch.column(i).to_numpy() for i in (0, 1)))
                size += len(batch)
            if size >= block:
                yield given_out()
                held, size = [], 0
        if held:
            yield given_out()

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, block: int = 1 << 19) -> DataFrame:
    """node, component (the least node reachable) for every node of edges (a, b: long).

    Blocks of edges are first contracted where they lie, at most a row for each of a block's nodes. If
    one block then holds all, its stars are the components. Otherwise there are rounds of taking the
    least label among neighbours and then the label's own label, until no label changes; the number of
    rounds grows with the logarithm of the longest path. Loops and repeated edges do no harm; edges
    with a null end are none; no edges give no rows. Tables are kept in parts of about a block.
    """
    found = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a is not null and b is not null")
    near = cut(contracted(found, block))
    parts = max(1, min(near.rdd.getNumPartitions(), 1 + near.count() // block))
    if parts == 1:
        return cut(contracted(near.coalesce(1), 2 * block).select(F.col("a").alias("node"), F.col("b").alias("component")))
    near = cut(contracted(near.coalesce(parts), block))
    both = cut(near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().coalesce(parts))
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")).coalesce(parts))
    while True:
        lowest = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        lower = labels.join(lowest, labels["node"] == lowest["a"]).select("node", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        lower = cut(lower.coalesce(parts))
        jump = lower.select(F.col("node").alias("at"), F.col("component").alias("next"))
        labels = cut(lower.join(jump, lower["component"] == jump["at"]).select("node", "was", F.least("component", "next").alias("component")).coalesce(parts))
        changed = labels.filter("component <> was").limit(1).count()
        labels = labels.select("node", "component")
        if not changed:
            return labels
