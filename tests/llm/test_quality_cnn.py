"""Held-out accuracy of the byte network; pooling and gradients by definition."""

import numpy as np
import pytest

from rainfold.llm import quality_cnn as Q
from rainfold.llm.common import held_out
from tests.conftest import SF_MID
from tests.llm.data import CLASHES, awkward_rows, documents


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    return Q.learn(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), ~held_out("_key", 3, 1))


def test_held_out_accuracy(spark, model):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(docs, model).join(labels, "doc_id").where(held_out("doc_id", 3, 1)).toPandas()
    assert (got.predicted == got.quality).mean() > 0.93
    assert got[got.quality == 1].predicted.mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_pools_are_maxima_over_all_windows():
    net = Q.Network(3)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (3, Q.CHUNK), dtype=np.uint8)
    best, at = net.pools(x, True)
    for i in range(3):
        y = np.stack([net.embed[x[i, a:a + Q.WIDTH]].ravel() @ net.filters for a in range(0, Q.CHUNK - Q.WIDTH + 1, Q.STRIDE)])
        assert np.allclose(np.maximum(y.max(0) + net.bias, 0), best[i], atol=1e-4)
        assert (y.argmax(0) * Q.STRIDE == at[i]).mean() > 0.95


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        starts = Q.chunk_starts(n)
        covered = {b for s in starts for b in range(s, min(s + Q.CHUNK, n))}
        assert covered == set(range(n))
        assert len(Q.chunks(bytes(n), starts)) == len(starts)


def test_gradients_by_differences():
    net = Q.Network(1)
    net.bias += 0.5  # away from the rectifier's kink
    rng = np.random.default_rng(2)
    docs = [Q.chunks(bytes(rng.integers(97, 123, n, dtype=np.uint8))) for n in (700, 100, 1500)]
    labels, weight = np.array([1, 0, 1]), np.ones(3)
    x = np.concatenate(docs)
    ends = np.cumsum([len(d) for d in docs])
    starts = np.r_[0, ends[:-1]]

    def loss():
        pool = net.pools(x).astype(float)
        feats = np.concatenate([np.add.reduceat(pool, starts) / (ends - starts)[:, None], np.maximum.reduceat(pool, starts)], 1)
        p = 1 / (1 + np.exp(-(feats @ net.out + net.out_bias[0])))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    pool, at = net.pools(x, True)
    grads = net._gradients(x, pool, at, starts, ends, labels, weight)
    for w, g in zip(net.weights, grads, strict=True):
        for flat in np.argsort(-np.abs(g).ravel())[:3]:
            i = np.unravel_index(flat, g.shape)
            old, step = w[i], 4e-4
            w[i] = old + step
            up = loss()
            w[i] = old - step
            down = loss()
            w[i] = old
            assert abs((up - down) / (2 * step) - g[i]) < 0.1 * abs(g[i]) + 6e-3


def test_awkward_texts_and_missing_labels(spark, model):
    rows = awkward_rows()
    docs = documents(spark, rows)
    got = Q.classify(docs, model).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == got.predicted.sum()
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, None, 0, "x"), (None, 0, 0, "x")], "doc_id long, quality int, toxic int, label string")
    assert Q.learn(docs, labels, ~held_out("_key", 3, 5)) == 1.0
    assert Q.learn(docs, labels.where("false"), ~held_out("_key", 3, 5)) == 0.5
    assert Q.classify(docs, 0.5).where("predicted = 1").count() == len(rows)
    assert Q.classify(documents(spark, []), model).count() == 0 and Q.keep_good(documents(spark, []), model).count() == 0
    assert set(CLASHES) <= set(kept.columns)
