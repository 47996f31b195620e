"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all its bytes.  Every
chunk goes through a byte embedding and one layer of learned filters, and the
rectified responses are max-pooled over the chunk; the means and the maxima of
its chunks' pools describe the document, and a logistic unit turns them into
one probability.

Fit: at most about ``TRAIN_ROWS`` labelled documents a class, chosen by a
seeded hash, of which up to ``TRAIN_CHUNKS`` evenly spread chunks are used
(documented bounds of the training sample).  Both classes weigh the same in
training, and the bias is then set back to the labels' own proportion.
Scoring covers every chunk of every document.

Edge cases: a null or empty text is one chunk of padding and is scored like any
other; without labels of both classes every score is the share of label 1
(0.5 if there are none); null labels and null ids aren't learned from; repeated
rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices, texts, utf8

TRAIN_ROWS = 1500
TRAIN_CHUNKS = 8
CHUNK, STEP = 512, 448
WIDTH, STRIDE = 8, 2
EMBED, FILTERS = 8, 32
EPOCHS, RATE, BATCH = 8, 0.005, 32
SEED = 9
#: Chunks that go through the filters at a time.
AT_ONCE = 128


def chunk_starts(n: int) -> range:
    """Starts of the overlapping chunks that cover ``n`` bytes."""
    return range(0, max(n - CHUNK, 0) + STEP, STEP) if n > CHUNK else range(1)


def chunks(text: bytes, starts=None) -> np.ndarray:
    """A row of CHUNK bytes for each start, zero-padded."""
    starts = chunk_starts(len(text)) if starts is None else starts
    flat = np.zeros(starts[-1] + CHUNK, np.uint8)
    flat[:len(text)] = np.frombuffer(text, np.uint8)[:len(flat)]
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[list(starts)]


def clip(doc: np.ndarray, turn: int) -> np.ndarray:
    """A chunk with the first words of a document, some 12 to 140 bytes."""
    out = np.zeros((1, CHUNK), np.uint8)
    head = doc[0, :12 + 16 * (turn % 9)]
    ends = np.flatnonzero(head == 32)
    n = ends[-1] if len(ends) else len(head)
    out[0, :n] = head[:n]
    return out


class Network:
    """Weights: embedding, filters with bias, output with bias."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.out_bias]

    def pools(self, x: np.ndarray, where: bool = False):
        """Each chunk's max-pooled responses; with ``where`` also the start of
        the window that gave them."""
        n = len(x)
        flat = self.embed[x.ravel()].reshape(-1)
        flat = np.concatenate([flat, np.zeros(WIDTH * EMBED, np.float32)])
        best = np.full((n, FILTERS), -np.inf, np.float32)
        at = np.zeros((n, FILTERS), np.int64)
        for shift in range(0, WIDTH, STRIDE):  # windows that start so far into each run of WIDTH bytes
            rows = flat[shift * EMBED:][:n * CHUNK * EMBED].reshape(-1, WIDTH * EMBED)
            y = (rows @ self.filters).reshape(n, CHUNK // WIDTH, FILTERS)[:, :CHUNK // WIDTH - (shift > 0)]
            top = y.max(1)
            if where:
                better = top > best
                at[better] = (y.argmax(1) * WIDTH + shift)[better]
            np.maximum(best, top, out=best)
        best += self.bias
        np.maximum(best, 0, out=best)
        return (best, at) if where else best

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, seed: int = SEED) -> None:
        """Adam on the logistic loss, both classes weighing the same."""
        rng = np.random.default_rng(seed)
        share = labels.mean()
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        turn = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(docs))
            for a in range(0, len(order), BATCH):
                ids = order[a:a + BATCH]
                x = np.concatenate([docs[i] for i in ids])
                ends = np.cumsum([len(docs[i]) for i in ids])
                starts = np.concatenate([[0], ends[:-1]])
                pool, at = self.pools(x, True)
                grads = self._gradients(x, pool, at, starts, ends, labels[ids], weight[ids])
                turn += 1
                for w, g, (m, v) in zip(self.weights, grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
        self.out_bias += np.float32(np.log(share / (1 - share)))

    def _gradients(self, x, pool, at, starts, ends, labels, weight):
        counts = ends - starts
        doc = np.repeat(np.arange(len(counts)), counts)
        top = np.maximum.reduceat(pool, starts)
        feats = np.concatenate([np.add.reduceat(pool, starts) / counts[:, None], top], 1)
        p = 1 / (1 + np.exp(-np.clip(feats @ self.out + self.out_bias[0], -30, 30)))
        d = ((p - labels) * weight / len(labels)).astype(np.float32)
        g_out, g_ob = d @ feats, np.array([d.sum()])
        g_feat = d[:, None] * self.out
        first = np.zeros(pool.shape, bool)  # one winner a document: overlapping chunks can tie
        for a, b in zip(starts, ends, strict=True):
            first[a + pool[a:b].argmax(0), np.arange(FILTERS)] = True
        g_pool = g_feat[doc, :FILTERS] / counts[doc, None] + np.where(first, g_feat[doc, FILTERS:], 0)
        g_pool = np.where(pool > 0, g_pool, 0).astype(np.float32)
        # Only the windows that won their pool get a gradient.
        c, f = np.nonzero(g_pool)
        spread = x[c[:, None], at[c, f][:, None] + np.arange(WIDTH)]
        g = g_pool[c, f]
        window = self.embed[spread].reshape(len(c), -1)
        g_filters = np.zeros_like(self.filters)
        np.add.at(g_filters.T, f, window * g[:, None])
        g_embed = np.zeros_like(self.embed)
        np.add.at(g_embed, spread.ravel(), (self.filters.T[f] * g[:, None]).reshape(-1, EMBED))
        return g_embed, g_filters, g_pool.sum(0), g_out, g_ob

    def score(self, docs: list[bytes]) -> np.ndarray:
        """One probability a document, from all its chunks."""
        counts = np.array([len(chunk_starts(len(t))) for t in docs])
        pool = np.empty((counts.sum(), FILTERS), np.float32)
        at = 0
        waiting: list[np.ndarray] = []

        def flush():
            nonlocal at
            x = np.concatenate(waiting)
            for a in range(0, len(x), AT_ONCE):
                part = x[a:a + AT_ONCE]
                pool[at + a:at + a + len(part)] = self.pools(part)
            at += len(x)
            waiting.clear()

        for t in docs:
            waiting.append(chunks(t))
            if sum(map(len, waiting)) >= AT_ONCE:
                flush()
        if waiting:
            flush()
        starts = np.concatenate([[0], counts.cumsum()[:-1]])
        feats = np.concatenate([np.add.reduceat(pool, starts) / counts[:, None], np.maximum.reduceat(pool, starts)], 1)
        return 1 / (1 + np.exp(-np.clip(feats.astype(np.float64) @ self.out + self.out_bias[0], -30, 30)))


def learn(df: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "quality"):
    """A network fitted to the labelled rows where ``train`` holds, or the
    share of label 1 where one class is missing."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("label"))
    rows = df.select(F.col(key).alias("_key"), utf8(text).alias("text")).where(train)
    counts = {r["label"]: r["n"] for r in rows.select("_key").join(marks, "_key").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("_key")), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("label") == 1, min(1.0, TRAIN_ROWS / counts[1])).otherwise(min(1.0, TRAIN_ROWS / counts[0]))
    chosen = marks.where(draw < share)  # chosen before the join: only their texts are looked at

    def spread(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for x in b.column(1):
                raw = x.as_py() or b""
                starts = chunk_starts(len(raw))
                picks = sorted({starts[round(i * (len(starts) - 1) / (TRAIN_CHUNKS - 1))] for i in range(TRAIN_CHUNKS)})
                out.append(chunks(raw, picks).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.binary())], names=["draw", "label", "chunks"])

    ship_package(df.sparkSession)
    sample = rows.join(F.broadcast(chosen), "_key").select(draw.alias("draw"), "text", F.col("label").cast("int").alias("label"))
    found = sample.mapInArrow(spread, "draw double, label int, chunks binary").collect()
    found.sort(key=lambda r: (r["draw"], r["chunks"]))
    docs = [np.frombuffer(bytes(r["chunks"]), np.uint8).reshape(-1, CHUNK) for r in found]
    marks = [r["label"] for r in found]
    # A short cut of a good document is good as well: they are rare in the sample, and need not look like long ones.
    short = [clip(d, i) for i, (d, m) in enumerate(zip(docs, marks, strict=True)) if m == 1][:TRAIN_ROWS // 4]
    docs, marks = docs + short, np.array(marks + [1] * len(short))
    net = Network()
    net.fit(docs, marks)
    sampled = [(marks == k).sum() for k in (0, 1)]
    # ``fit`` puts the sample's proportion into the bias; all labels' proportion belongs there.
    net.out_bias += np.float32(np.log(counts[1] / counts[0]) - np.log(sampled[1] / sampled[0]))
    return net


def classify(df: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (probability of label 1), predicted."""

    def run(batches):
        import pyarrow as pa

        for rows in texts(batches, 4 << 20):
            for part in slices(rows, lambda r: len(r[1]) + CHUNK, 1 << 20):
                score = model.score([t for _, t in part]) if isinstance(model, Network) else np.full(len(part), model)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in part], keys), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    keys = to_arrow_type(kind)
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, score double, predicted int")


def keep_good(df: DataFrame, model, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose predicted label is 1, all columns as they are."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            col, good = b.column(b.schema.get_field_index(text)), []
            for part in slices(((x.as_py() or "").encode() for x in col), lambda t: len(t) + CHUNK, 1 << 20):
                score = model.score(part) if isinstance(model, Network) else np.full(len(part), model)
                good += (score >= 0.5).tolist()
            yield b.filter(pa.array(good, pa.bool_()))

    ship_package(df.sparkSession)
    return df.mapInArrow(run, df.schema)
