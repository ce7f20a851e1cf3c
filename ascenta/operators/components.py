"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize


def _union_find(edges: DataFrame) -> DataFrame:
    """Components of edges that fit one task: labels hook onto lesser ones and are shortened until nothing moves."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        a, b = (np.concatenate(side) for side in zip(*held, strict=True))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = at[: len(a)], at[len(a) :]
        label = np.arange(len(nodes))
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "root"])

    return edges.repartition(1).mapInArrow(kernel, "node long, root long")


def connected(edges: DataFrame, one_task: int = 0) -> DataFrame:
    """The least node of each node's component (node, root), from *edges* (a, b: long); isolated nodes need no row.

    Alternates the large-star and small-star steps, each a grouped minimum (combined
    before the shuffle) joined back to its edges, until the edges are stars; their
    number of rounds grows with the logarithm of the longest path. Edges and
    minima are written to the shared folder, so that neither side of the joins is
    dealt already and Spark can split the edges of a node that has very many; only
    the edges' count and a sum of hashes come to the driver. At most *one_task*
    edges (16 bytes each) are solved in one task instead, with the same result.
    """
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    now = materialize(edges.where("a <> b").select(high, low).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark is None and 0 < seen[0] <= one_task:
            return _union_find(now)
        if seen == mark or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
