"""Connected components of an edge table by alternating star contraction.

Rounds of large-star and small-star steps (Kiveris et al., Connected Components in MapReduce
and Beyond, 2014) turn every component into a star around its smallest node. Every round ends
in a table in the shared folder; only counts and sums come to the driver. A graph of few links can
be worked on by one task instead, which spares the driver some fifty jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.storage import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u, v. Large: link each larger neighbour to the smallest of node and neighbours. Small: link node and smaller neighbours to the smallest."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low.select(F.col("u").alias("n"), "m"), F.col("u") == F.col("n"))
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def lowest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links u, v in order, and for each the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _in_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links to node, component."""
    pairs = [[x.to_numpy(zero_copy_only=False) for x in batch.columns] for batch in batches if batch.num_rows]
    if pairs:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in lowest(*map(np.concatenate, zip(*pairs)))], names=["node", "component"])


def connected_components(edges: DataFrame, name: str = "components", few: int = 0) -> DataFrame:
    """node, component (its smallest node) of every node in ``edges`` (columns u, v of one type).

    Up to ``few`` distinct links, of longs then, are worked on by one task, more of them in rounds.
    """
    now, before = materialize(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), name), None
    if few and now.count() <= few:
        return materialize(now.coalesce(1).mapInArrow(_in_one, "node long, component long"), name)
    while True:
        now = materialize(_star(materialize(_star(now, True), name), False), name)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select("v", "v").distinct())
