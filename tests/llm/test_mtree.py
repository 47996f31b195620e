"""Top-k search against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.llm import mtree

SCHEMA = "vec_id long, embedding array<float>, label int, row string, page string"


def plain(rows, k=5, every=50):
    fine = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in fine), default=0)
    fine = [(i, np.pad(v, (0, width - len(v)))) for i, v in fine]
    out = []
    for a, (i, v) in enumerate(fine):
        if i % every == 0:
            best = sorted((-int(v @ w), j) for b, (j, w) in enumerate(fine) if b != a)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def table(rng, n, width=12, clusters=5):
    centers = rng.normal(size=(clusters, width))
    return [(int(i), (centers[i % clusters] + rng.normal(scale=0.3, size=width)).tolist(), 0, "x", "y") for i in range(n)]


@pytest.mark.parametrize(("page", "queries"), [(8192, 4096), (60, 7)])
def test_against_all_products(spark, monkeypatch, page, queries):
    rng = np.random.default_rng(3)
    rows = table(rng, 700)
    rows += [(1000 + i, rows[0][1], 0, "x", "y") for i in range(300)]  # a large group of copies: ties
    rows += [(50, rows[9][1], 0, "x", "y"), (2000, None, 0, "x", "y"), (2050, [1.0, None] * 6, 0, "x", "y"), (2100, [float("nan")] * 12, 0, "x", "y"),
             (2150, [float("inf")] * 12, 0, "x", "y"), (None, rows[3][1], 0, "x", "y"), (2200, [], 0, "x", "y"), (2250, [0.5, -0.5], 0, "x", "y")]
    monkeypatch.setattr(mtree, "PAGE_ROWS", page)
    monkeypatch.setattr(mtree, "QUERY_ROWS", queries)
    monkeypatch.setattr(mtree, "PIVOTS", 6)
    got = mtree.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_search_skips_what_the_bounds_rule_out():
    rng = np.random.default_rng(5)
    x = mtree.augmented(np.floor(256 * np.concatenate([rng.normal(loc=c, scale=0.05, size=(400, 6)) for c in (-3, -1, 1, 3)])), 1e9)
    tree = mtree.build(x, np.arange(len(x)), x[0], 0.0, np.random.default_rng(0))

    def check(node):
        below = node.rows if node.rows is not None else np.concatenate([check(c) for c in node.children])
        assert np.sqrt(((x[below] - node.center) ** 2).sum(1)).max() <= node.radius + 1e-9
        return below

    assert sorted(check(tree).tolist()) == list(range(len(x)))
    q = np.r_[x[17, :-1], 0.0]
    got = mtree.search(tree, x, np.arange(len(x)), np.arange(len(x)), q, 17, 5, float(q @ q) + 1e9, -np.inf)
    scores = x[:, :-1] @ q[:-1]
    assert got == sorted(((float(s), i) for i, s in enumerate(scores) if i != 17), key=lambda t: (-t[0], t[1]))[:5]


def test_few_and_none(spark):
    one = spark.createDataFrame([(50, [1.0], 0, "x", "y")], SCHEMA)
    assert mtree.top_k(one, F.col("id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(50, [1.0], 0, "x", "y"), (51, [2.0], 0, "x", "y")], SCHEMA)
    assert [tuple(r) for r in mtree.top_k(two, F.col("id") % 50 == 0).collect()] == [(50, 1, 51, 256 * 512)]
    empty = mtree.top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
