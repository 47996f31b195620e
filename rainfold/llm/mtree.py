"""Exact top-k inner products by best-first search in M-trees.

Inner products become distances: with M the largest length, x goes to
(x, sqrt(M^2 - |x|^2)) and a query to (q, 0), so that
d(q, x)^2 = |q|^2 + M^2 - 2 <q, x>, and the triangle inequality holds.

The top of the tree is a level of at most ``PIVOTS`` routing vectors; each
row belongs to its nearest, and a routing vector's rows are dealt into pages of
about ``PAGE_ROWS`` (a crowded one has many).  A page's rows form an M-tree in
the task that holds it: nodes with a routing vector, covering radius and
distance to the parent's routing vector.  A query searches the pages of its
nearest routing vector first, then those of the others whose balls its k-th
best distance still reaches.  Within a tree the search is best-first; the
stored parent distances rule out children and entries before their own
distance is computed.  Queries come in blocks of about ``QUERY_ROWS``.

A row's score is its exact integer inner product (as long as it stays below 2^53);
nothing is ruled out unless its bound is beyond the k-th best by more than
rounding, so ties are all seen and go to the smaller id.

Edge cases: null vectors, null ids, and vectors with a null or non-finite
component take no part; shorter vectors count as padded with zeros; repeated
rows are rows of their own (only the query's own row is left out); fewer than
k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
import itertools
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialize, ship_package

PIVOTS = 64
PAGE_ROWS = 8192
QUERY_ROWS = 4096
LEAF = 128
FANOUT = 16
SEED = 8


def quantized(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(row, id, v): the rows that take part, v = floor(scale * x) as longs."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
                       F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def as_matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


@dataclass
class Node:
    """A routing vector's subtree: its covering radius, its distance to the
    parent's routing vector, and either children or entries with their
    distances to the routing vector."""

    center: np.ndarray
    radius: float
    to_parent: float
    children: list[Node] = field(default_factory=list)
    rows: np.ndarray | None = None
    to_center: np.ndarray | None = None
    centers: np.ndarray | None = None
    radii: np.ndarray | None = None
    apart: np.ndarray | None = None


def build(x: np.ndarray, rows: np.ndarray, center: np.ndarray, to_parent: float, rng) -> Node:
    """Bulk-load the rows below a routing vector."""
    dist = np.sqrt(((x[rows] - center) ** 2).sum(1))
    node = Node(center, float(dist.max(initial=0.0)), to_parent)
    if len(rows) > LEAF and node.radius > 0:
        seeds = x[rng.choice(rows, min(FANOUT, len(rows)), replace=False)]
        near = ((seeds ** 2).sum(1) - 2 * x[rows] @ seeds.T).argmin(1)
        parts = [(s, rows[near == s]) for s in range(len(seeds))]
        if max(len(p) for _, p in parts) < len(rows):
            node.children = [build(x, p, seeds[s], float(np.sqrt(((seeds[s] - center) ** 2).sum())), rng) for s, p in parts if len(p)]
            node.centers = np.stack([c.center for c in node.children])
            node.radii = np.array([c.radius for c in node.children])
            node.apart = np.array([c.to_parent for c in node.children])
            return node
    order = np.argsort(dist, kind="stable")
    node.rows, node.to_center = rows[order], dist[order]
    return node


def search(root: Node, x: np.ndarray, ids: np.ndarray, own: np.ndarray, q: np.ndarray, query: int, k: int, base: float, floor: float) -> list[tuple[float, int]]:
    """The (score, id) of the k best rows but the query's own, best first.

    ``x`` holds augmented rows, ``q`` the augmented query, ``base`` is
    |q|^2 + M^2; rows that score below ``floor`` needn't be found.
    """
    best: list[tuple[float, int]] = []  # a heap, the worst first: (score, -id)
    reach = float(np.sqrt(max(base - 2 * floor, 0.0))) if floor > -np.inf else np.inf
    slack = 1e-9 * base + 1e-6
    turn = itertools.count()
    d = float(np.sqrt(((q - root.center) ** 2).sum()))
    queue = [(max(d - root.radius, 0.0), next(turn), d, root)]
    while queue:
        least, _, d, node = heapq.heappop(queue)
        if least > reach + slack:
            break
        if node.rows is None:
            ok = np.abs(d - node.apart) - node.radii <= reach + slack  # no distance computed yet
            at = np.flatnonzero(ok)
            if len(at):
                dist = np.sqrt(((node.centers[at] - q) ** 2).sum(1))
                low = np.maximum(dist - node.radii[at], 0)
                for i, e, m in zip(at.tolist(), dist.tolist(), low.tolist(), strict=True):
                    if m <= reach + slack:
                        heapq.heappush(queue, (m, next(turn), e, node.children[i]))
            continue
        # Entries are sorted by their distance to the routing vector: those within reach are neighbours.
        a, b = np.searchsorted(node.to_center, [d - reach - slack, d + reach + slack])
        rows = node.rows[a:b]
        scores = x[rows, :-1] @ q[:-1]
        if len(best) == k:
            keep = scores >= best[0][0]
            rows, scores = rows[keep], scores[keep]
        for r, s in zip(rows.tolist(), scores.tolist(), strict=True):
            if own[r] != query:
                item = (s, -int(ids[r]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        if len(best) == k:
            reach = min(reach, float(np.sqrt(max(base - 2 * best[0][0], 0.0))))
    return [(s, -i) for s, i in sorted(best, key=lambda t: (-t[0], -t[1]))]


FOUND = "qrow long, query_id long, vec_id long, score long"


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = materialize(quantized(df, key, vector, scale), "mtree-rows")
    size = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm")).first()
    width, norm = max(size["width"] or 0, 1), size["norm"] or 0.0
    drawn = rows.orderBy(F.xxhash64(F.lit(SEED), F.col("row")), "row").limit(PIVOTS).select("v").collect()
    pivots = augmented(as_matrix([r["v"] for r in drawn], width), norm)
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def route(batches):
        import pyarrow as pa

        for b in batches:
            x = augmented(as_matrix(b.column(2).to_pylist(), width), norm)
            dist = distances(x, pivots)
            near = dist.argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32)), pa.array(dist[np.arange(len(x)), near])], names=["row", "id", "v", "pivot", "dist"])

    routed = materialize(rows.mapInArrow(route, "row long, id long, v array<long>, pivot int, dist double"), "mtree-routed")
    stats = {r["pivot"]: r for r in routed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()}  # PIVOTS at most
    pages = {p: -(-r["n"] // PAGE_ROWS) for p, r in stats.items()}
    radii = np.array([stats[p]["radius"] if p in stats else -1.0 for p in range(len(pivots))])
    queries = routed.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    page_count = F.element_at(F.create_map(*[F.lit(x) for kv in pages.items() for x in kv]), F.col("pivot"))
    held = routed.withColumn("page", F.pmod(F.xxhash64("row"), page_count).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("pivot", "page", "block", "row", "id", "v")

    def look(page, asked):
        import pandas as pd

        if not len(page) or not len(asked):
            return pd.DataFrame({"qrow": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
        page = page.sort_values("row", ignore_index=True)
        x = augmented(as_matrix(page["v"].tolist(), width), norm)
        rng = np.random.default_rng(SEED)
        tree = build(x, np.arange(len(x)), x[0], 0.0, rng)
        ids, own = page["id"].to_numpy(), page["row"].to_numpy()
        q = np.c_[as_matrix(asked["v"].tolist(), width), np.zeros(len(asked))]
        out = []
        for i, (row, id_, floor) in enumerate(zip(asked["row"].tolist(), asked["id"].tolist(), asked["floor"].tolist(), strict=True)):
            base = float(q[i] @ q[i]) + norm
            out += [(row, id_, v, int(s)) for s, v in search(tree, x, ids, own, q[i], row, k, base, floor)]
        return pd.DataFrame(out, columns=["qrow", "query_id", "vec_id", "score"]).astype("int64")

    def searched(asked):
        asked = asked.withColumn("page", F.explode(F.sequence(F.lit(0), page_count - 1)))
        asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")).select("pivot", "page", "block", "row", "id", "v", "floor")
        place = ["pivot", "page", "block"]
        return held.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(look, FOUND)

    at_home = materialize(searched(queries.withColumn("floor", F.lit(float("-inf")))), "mtree-home")
    kth = at_home.groupBy("qrow").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(  # k for each page of one routing vector
        "qrow", F.when(F.size("s") >= k, F.element_at("s", k).cast("double")).otherwise(float("-inf")).alias("floor"))
    bounded = queries.join(kth, queries["row"] == kth["qrow"], "left").select("row", "id", "v", F.col("pivot").alias("home"), F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))

    def spread(batches):
        import pyarrow as pa

        for b in batches:
            q = np.c_[as_matrix(b.column(2).to_pylist(), width), np.zeros(b.num_rows)]
            base = (q ** 2).sum(1) + norm
            reach = np.sqrt(np.maximum(base - 2 * np.maximum(b.column(4).to_numpy(), -norm - base), 0))
            open_ = (distances(q, pivots) - radii <= (reach + 1e-9 * base + 1e-6)[:, None]) & (radii >= 0)
            open_[np.arange(len(q)), b.column(3).to_numpy()] = False
            i, p = np.nonzero(open_)
            i = pa.array(i)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(i) for c in (0, 1, 2, 4)), pa.array(p.astype(np.int32))], names=["row", "id", "v", "floor", "pivot"])

    others = searched(bounded.mapInArrow(spread, "row long, id long, v array<long>, floor double, pivot int"))
    best = Window.partitionBy("qrow").orderBy(F.col("score").desc(), "vec_id")
    both = at_home.unionByName(others).withColumn("rank", F.row_number().over(best).cast("int"))
    return both.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def augmented(x: np.ndarray, norm: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(norm - (x ** 2).sum(1), 0))]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(1), 0))
