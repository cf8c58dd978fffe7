"""Connected components by least labels; nothing is collected to the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions

#: Edges that one task takes at once; where there are more, labels spread in rounds over all tasks.
FEW = 1 << 18


def least_labels(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For the nodes 0 to n - 1 the least node reachable by edges (x, y)."""
    label = np.arange(n)
    while True:
        a, b = label[x], label[y]
        low = np.minimum(a, b)
        new = label.copy()
        for ends in (x, y, a, b):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def at_once(edges: DataFrame) -> DataFrame:
    """components() in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def label(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        nodes = pa.chunked_array([*table["a"].chunks, *table["b"].chunks]).unique()
        nodes = nodes.take(pc.sort_indices(nodes))
        x, y = (np.asarray(pc.index_in(table[c], nodes)).astype(np.int64) for c in ("a", "b"))
        yield pa.record_batch([nodes, nodes.take(pa.array(least_labels(x, y, len(nodes))))], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(label, f"node {kind}, component {kind}")


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): the least node reachable. Loops and repeated edges do no harm.

    edges: checkpoints, read as often as needed. Up to `few` edges go to one task. Of more, each round takes the
    least label among neighbours, then the label's own label, so that paths halve; rounds are checkpointed. A hub's
    edges are reduced before the shuffle.
    """
    edges = edges.select("a", "b").coalesce(partitions(edges.sparkSession))
    if edges.count() <= few:
        return cut(at_once(edges))
    both = cut(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")).distinct())
    labels = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label"))
    while True:
        near = both.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, "x").select("x", F.least("label", "near").alias("next"), F.col("label").alias("before"))
        jump = step.select(F.col("x").alias("next"), F.col("next").alias("far"))
        new = cut(step.join(jump, "next").select("x", F.least("next", "far").alias("label"), "before"))
        labels = new.select("x", "label")
        if new.filter("label != before").isEmpty():
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
