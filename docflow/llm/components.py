"""Connected components of a graph given by its edges, by label propagation with pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.shared import cut

#: Children of a node in the trees that stand for a group of linked nodes: low enough that no node becomes a hub.
FAN_OUT = 64


def components(edges: DataFrame) -> DataFrame:
    """edges: (a long, b long). Returns (node, component) for each node with an edge to another; component is the smallest node reachable.

    Nulls and loops are left out. Labels live in tables; the driver only learns whether a round changed any.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = cut(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")))
    while not labels.where("changed").isEmpty():
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = cut(step.join(up, "label").select("node", F.least("label", "up").alias("label"), (F.least("label", "up") != F.col("old")).alias("changed")))
    return labels.select("node", F.col("label").alias("component"))


def local_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest index linked to each of n items by the pairs (a, b), beside what labels already link."""
    labels = np.arange(n) if labels is None else labels.copy()
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return labels
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(labels, high, low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def tree_edges(labels: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that link the nodes of each label, FAN_OUT children to a node."""
    order = np.lexsort((nodes, labels))
    labels, nodes = labels[order], nodes[order]
    first = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]])) if len(labels) else np.zeros(0, int)
    begin = np.repeat(first, np.diff(np.concatenate([first, [len(labels)]])))
    rank = np.arange(len(labels)) - begin
    child = np.flatnonzero(rank > 0)
    return nodes[child], nodes[begin[child] + (rank[child] - 1) // FAN_OUT]
