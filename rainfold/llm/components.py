"""Connected components of an edge table of long node numbers.

Each partition first replaces its edges by stars of the components it sees,
so no more edges than nodes are shuffled.  Large-star and small-star rounds
(alternating; each node hands its neighbours to the smallest of them) follow
until nothing changes.  Every round is written to the shared checkpoint
folder; minima are aggregated before the shuffle and joined back, so a node
with many neighbours can be split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package

#: Edges that a task contracts at a time.
CONTRACT_ROWS = 2_000_000


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) of the components of edges a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        low, high = np.minimum(rx, ry), np.maximum(rx, ry)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def contract(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, at most a node's worth a task."""

    def run(batches):
        import pyarrow as pa

        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def stars():
            a, b = local_stars(*(np.concatenate(c) for c in zip(*held, strict=True)))
            held[:] = [(a, b)]
            return len(a)

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            n += batch.num_rows
            if n > CONTRACT_ROWS:
                n = stars()
                if n > CONTRACT_ROWS // 2:  # few of them share components: let them go
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names=["a", "b"])
                    n = 0
        if held:
            stars()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names=["a", "b"])

    ship_package(edges.sparkSession)
    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node that
    isn't its own root.  ``edges`` has long columns a and b."""
    now = materialize(contract(edges).where("a <> b").distinct(), "cc")
    mark = None
    while True:
        # Large star: to every larger neighbour goes the smallest of the node's neighbourhood.
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: the same for the smaller neighbours and the node itself.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        down = materialize(down, "cc")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(contract(small.unionByName(least.select("a", F.col("m").alias("b")))).distinct(), "cc")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)
