"""Secret scans: a character convolutional network over candidates in context.

Base findings come from three patterns (assignments, access keys, hex runs) and
always stay.  Every other run of at least 12 key characters with a digit is a
candidate.  A small network in numpy looks at each finding's or candidate's
characters and their surroundings: a character embedding, one layer of learned
filters, max-pooling over the candidate and over its context apart, and a
logistic unit.

Fit: all findings of the corpus, base findings as positive and the other
candidates as negative, equal ones once; classes weigh the same.  Three quarters
train, in parts of about ``PART_ROWS`` dealt by a seeded hash: every round each
part goes on from the common parameters over all its rows, and what the parts
learned is averaged.  On the last quarter the score is calibrated (Platt scaling
by sums over its rows) and the threshold set, the highest at which every kind
of base finding keeps a recall of ``RECALL``, 0.5 at least; its order statistics
are exact.  Candidates above it are added as kind ``net``.  Only parameters, sums
and bucket counts come to the driver.

Edge cases: a null text is empty and has no spans; without positives or without
negatives nothing is added; null ids and repeated rows are scanned like any
other; long texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import operator
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, texts, utf8

KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
DIGIT = re.compile(r"[0-9]")
# The same on bytes, to leave most texts after one fast look.
HINTS = (b"passw", b"secret", b"token", b"api")
HEX_BYTES, DIGIT_BYTES = re.compile(rb"[0-9a-f]{16}"), re.compile(rb"[0-9]")

LEFT, BODY, RIGHT = 32, 48, 16
LENGTH = LEFT + BODY + RIGHT
WIDTH, EMBED, FILTERS = 5, 8, 24
EPOCHS, RATE, BATCH = 12, 0.01, 64
#: Steps at least, so that a small corpus is learned as well.
STEPS = 400
#: Training rows of a part, about.
PART_ROWS = 4096
RECALL = 0.98
SEED = 2


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings, in code points, sorted."""
    low = raw.lower()
    assign, access, hexes = any(h in low for h in HINTS), b"AKIA" in raw, HEX_BYTES.search(raw)
    if not (assign or access or hexes):
        return []
    text = raw.decode()
    out = []
    if assign:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if access:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if hexes:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(raw: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the runs that no base finding touches."""
    if not DIGIT_BYTES.search(raw):
        return []
    out, at = [], 0
    reach = []  # the furthest end so far, for a sorted sweep
    for s, _, e in base:
        reach.append((s, max(e, reach[-1][1]) if reach else e))
    for m in CANDIDATE.finditer(raw.decode()):
        if not DIGIT.search(m[0]):
            continue
        while at < len(reach) and reach[at][0] < m.end():
            at += 1
        if not at or reach[at - 1][1] <= m.start():
            out.append(m.span())
    return out


def window(text: str, start: int, end: int) -> bytes:
    """LENGTH bytes: the context before, the candidate (its ends, if long), the context after."""
    body = text[start:end]
    if len(body) > BODY:
        body = body[:BODY // 2] + body[-BODY // 2:]
    left, right = text[max(0, start - LEFT):start], text[end:end + RIGHT]
    return (left.rjust(LEFT, "\0") + body.ljust(BODY, "\0") + right.ljust(RIGHT, "\0")).encode("ascii", "replace")


@dataclass
class Scanner:
    """The network with its calibration and threshold."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @classmethod
    def new(cls, seed: int = SEED) -> Scanner:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.5, (128, EMBED)), rng.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
                   np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1))

    def pools(self, x: np.ndarray):
        """Max-pooled responses over the candidate and over its context, and where."""
        wins = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
        y = np.maximum(self.embed[wins].reshape(*wins.shape[:2], -1) @ self.filters + self.bias, 0)
        inside = np.arange(LEFT, LEFT + BODY - WIDTH + 1)
        outside = np.setdiff1d(np.arange(LENGTH - WIDTH + 1), inside)
        at = np.concatenate([inside[y[:, inside].argmax(1)], outside[y[:, outside].argmax(1)]], 1)
        pool = np.take_along_axis(y, at.reshape(len(x), 2, FILTERS), 1).reshape(len(x), -1)
        return pool, at

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self.pools(x[a:a + 256])[0] @ self.out + self.out_bias[0] for a in range(0, len(x), 256)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def score(self, windows: list[bytes]) -> np.ndarray:
        """Calibrated probabilities that the windows hold secrets."""
        return _sigmoid(self.slope * self.logits(as_matrix(windows)) + self.shift)

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.out_bias]

    def state(self) -> np.ndarray:
        """What training starts from: parameters, Adam's moments, steps made."""
        flat = np.concatenate([w.ravel() for w in self.params()])
        return np.concatenate([flat, np.zeros(2 * len(flat) + 1)])

    def load(self, state: np.ndarray) -> list[list[np.ndarray]]:
        """Take over a state's parameters; its moments, in their shapes."""
        sizes = [w.size for w in self.params()]
        cut = np.split(state[:-1], np.cumsum(3 * sizes)[:-1])  # three lists in a row
        for w, part in zip(self.params(), cut, strict=False):
            w[...] = part.reshape(w.shape)
        return [[m.reshape(w.shape).copy() for w, m in zip(self.params(), cut[k * len(sizes):], strict=False)] for k in (1, 2)]

    def train(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, state: np.ndarray, rates: list[float], seed) -> np.ndarray:
        """The state after a pass over all rows for each rate."""
        rng = np.random.default_rng(seed)
        first, second = self.load(state)
        turn = state[-1]
        for rate in rates:
            order = rng.permutation(len(y))
            for a in range(0, len(order), BATCH):
                ids = order[a:a + BATCH]
                grads = self._gradients(x[ids], y[ids], weight[ids])
                turn += 1
                for w, g, m, v in zip(self.params(), grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
        return np.concatenate([*(w.ravel() for w in (*self.params(), *first, *second)), [turn]])

    def _gradients(self, x, y, weight):
        pool, at = self.pools(x)
        d = (_sigmoid(pool @ self.out + self.out_bias[0]) - y) * weight / len(y)
        g_pool = np.where(pool > 0, d[:, None] * self.out, 0)
        rows, cols = np.nonzero(g_pool)
        f, g = cols % FILTERS, g_pool[rows, cols]
        spread = x[rows[:, None], at[rows, cols][:, None] + np.arange(WIDTH)]
        g_filters, g_embed, g_bias = np.zeros_like(self.filters), np.zeros_like(self.embed), np.zeros_like(self.bias)
        np.add.at(g_filters.T, f, self.embed[spread].reshape(len(f), -1) * g[:, None])
        np.add.at(g_embed, spread.ravel(), (self.filters.T[f] * g[:, None]).reshape(-1, EMBED))
        np.add.at(g_bias, f, g)
        return g_embed, g_filters, g_bias, d @ pool, np.array([d.sum()])


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def as_matrix(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, LENGTH).astype(np.int64)


def findings(df: DataFrame, text: str = "text") -> DataFrame:
    """(kind, window): every base finding and every candidate (kind 3) of the table."""

    def run(batches):
        import pyarrow as pa

        for rows in texts(batches):
            out = []
            for _, raw in rows:
                base = base_spans(raw)
                spans = [(k, s, e) for s, k, e in base] + [(3, s, e) for s, e in candidates(raw, base)]
                if spans:
                    body = raw.decode()
                    out += [(k, window(body, s, e)) for k, s, e in spans]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([w for _, w in out], pa.binary())], names=["kind", "window"])

    ship_package(df.sparkSession)
    return df.select(F.lit(None).cast("int").alias("key"), utf8(text).alias("text")).mapInArrow(run, "kind int, window binary")


def fit(scanner: Scanner, rows: DataFrame, counts: dict[bool, int]) -> None:
    """Train on all (draw, kind, window); ``counts`` are those of base findings and others."""
    n = sum(counts.values())
    parts = -(-n // PART_ROWS)
    weights = {base: 0.5 * n / k for base, k in counts.items()}
    passes = max(EPOCHS, -(-STEPS * BATCH // n))
    rounds = EPOCHS if parts > 1 else 1  # one part has nothing to average
    each = -(-passes // rounds)
    part = F.pmod(F.shiftright("draw", 2), F.lit(parts)).cast("int")
    dealt = rows.select(part.alias("part"), "draw", "kind", "window").repartition(parts, "part").sortWithinPartitions("part", "draw", "window")
    state = scanner.state()
    for turn in range(rounds):
        rates = [RATE * (1 - i / (rounds * each)) for i in range(turn * each, (turn + 1) * each)]
        learnt = dealt.mapInArrow(_trainer(state, weights, n, rates, turn), "place int, value long").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        state[learnt["place"].to_numpy()] = learnt["value"].to_numpy() / STEP
    scanner.load(state)


#: Shares of parameters are summed as multiples of 1 / STEP: the same in any order.
STEP = 2.0 ** 48


def _trainer(state: np.ndarray, weights: dict[bool, float], n: int, rates: list[float], turn: int):
    """(place, value): each part's state after its passes, by its share of the rows."""

    def run(batches):
        import pyarrow as pa

        def rows():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in (b.column(0), b.column(2), b.column(3))), strict=True)

        for part, held in itertools.groupby(rows(), lambda r: r[0]):
            held = list(held)
            y = np.array([float(k < 3) for _, k, _ in held])
            new = Scanner.new().train(as_matrix([w for *_, w in held]), y, np.where(y == 1, weights[True], weights[False]), state, rates, [SEED, turn, part])
            value = np.rint(new * (len(y) / n) * STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value)], names=["place", "value"])

    return run


def calibrate(scanner: Scanner, rows: DataFrame, counts: dict[bool, int], recall: float = RECALL) -> None:
    """Platt scaling by Newton steps, then the recall-constrained threshold, from
    all held-back (kind, window)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            z = np.clip(scanner.logits(as_matrix(b.column(1).to_pylist())), -30, 30)
            low = z.astype(np.float32)
            low = np.where(low > z, np.nextafter(low, np.float32(-31)), low)
            bits = low.view(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(z), pa.array(bits ^ (bits >> 31 & 0x7FFFFFFF))], names=["kind", "z", "place"])

    scored = materialize(rows.select("kind", "window").mapInArrow(run, "kind int, z double, place int"), "secret-logits")
    n1, n0 = counts[True], counts[False]
    goal, z = F.when(F.col("kind") < 3, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2)), F.col("z")
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + F.exp(-(a * z + b)))
        terms = scored.select(z, (p - goal).alias("d"), (p * (1 - p) + 1e-6).alias("w"))
        s = terms.agg(F.sum(F.col("d") * z), F.sum("d"), F.sum(F.col("w") * z * z), F.sum(F.col("w") * z), F.sum("w")).first()
        step = np.linalg.solve(np.array([[s[2] + 1e-3, s[3]], [s[3], s[4] + 1e-3]]), np.array([s[0] + 1e-3 * (a - 1), s[1]]))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-11:
            break
    scanner.slope, scanner.shift = max(round(a, 9), 1e-3), round(b, 9)
    least = lowest(scored.where("kind < 3"), 1 - recall)
    scanner.threshold = max(0.5, float(_sigmoid(scanner.slope * least + scanner.shift)))


def lowest(scored: DataFrame, share: float) -> float:
    """The least over the kinds of the logit below which ``share`` of a kind's rows
    lie, by counts in buckets that grow finer; ``place`` sorts like the logits."""
    sizes = {r["kind"]: r["count"] for r in scored.groupBy("kind").count().collect()}
    left, bucket = {k: int(share * n) for k, n in sizes.items()}, dict.fromkeys(sizes)
    for shift in (20, 10, 0):
        rows = scored
        if shift < 20:
            mine = F.shiftright("place", shift + 10)
            rows = rows.where(functools.reduce(operator.or_, [(F.col("kind") == k) & (mine == v) for k, v in bucket.items()]))
        found = rows.groupBy("kind", F.shiftright("place", shift).alias("bucket")).count().collect()
        for kind in sizes:
            for r in sorted((r for r in found if r["kind"] == kind), key=lambda r: r["bucket"]):
                bucket[kind] = r["bucket"]
                if left[kind] < r["count"]:
                    break
                left[kind] -= r["count"]
    bits = np.array([min(bucket.values())], np.int32)
    return float((bits ^ (bits >> 31 & 0x7FFFFFFF)).view(np.float32)[0])


def learn(df: DataFrame, text: str = "text") -> Scanner | None:
    """A scanner fitted to all the table's findings."""
    draw = F.xxhash64(F.lit(SEED), F.col("window"))
    kinds = findings(df, text).groupBy("kind", "window").agg(F.lit(1))  # copies count once
    found = materialize(kinds.select(draw.alias("draw"), "kind", "window"), "findings")
    held = F.pmod("draw", F.lit(4)) == 3
    counts = {(r[0], r[1]): r[2] for r in found.groupBy(held.alias("held"), (F.col("kind") < 3).alias("base")).count().collect()}
    if len(counts) < 4:
        return None
    scanner = Scanner.new()
    fit(scanner, found.where(~held), {base: counts[False, base] for base in (True, False)})
    calibrate(scanner, found.where(held), {base: counts[True, base] for base in (True, False)})
    return scanner


def scan_texts(raws: list[bytes], scanner: Scanner | None) -> list[list[tuple[int, int, int]]]:
    """Each text's (start, kind, end), base findings and what the scanner adds."""
    out, waiting, windows = [], [], []
    for i, raw in enumerate(raws):
        base = base_spans(raw)
        out.append(base)
        if scanner is not None and (more := candidates(raw, base)):
            body = raw.decode()
            waiting += [(i, s, e) for s, e in more]
            windows += [window(body, s, e) for s, e in more]
    if windows:
        for (i, s, e), p in zip(waiting, scanner.score(windows), strict=True):
            if p >= scanner.threshold:
                out[i] = out[i] + [(s, 3, e)]
    return [sorted(spans) for spans in out]


def span_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(df: DataFrame, scanner: Scanner | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"]

    def run(batches):
        import pyarrow as pa

        for rows in texts(batches):
            out = []
            for (k, _), spans in zip(rows, scan_texts([t for _, t in rows], scanner), strict=True):
                n = [sum(x[1] == kind for x in spans) for kind in range(4)]
                base = span_text([x for x in spans if x[1] < 3])
                out.append((k, *n[:3], hashlib.sha256(base.encode()).hexdigest(), span_text(spans), n[3]))
            cols = list(zip(*out, strict=True))
            kinds = [keys, *[pa.int64()] * 3, pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    keys = to_arrow_type(kind)
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")


MASK = "[secret]"


def masked(raw: bytes, spans) -> str:
    """The text with every run of overlapping spans replaced by MASK."""
    text, out, at = raw.decode(), [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, scanner: Scanner | None, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The table with all spans masked in ``text`` (null stays null) and, where
    there is such a column, ``n_chars`` counted anew for the rows that changed."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at = b.schema.get_field_index(text)
            bodies, changed = b.column(at).to_pylist(), {}
            for a in range(0, len(bodies), 256):
                raws = [(x or "").encode() for x in bodies[a:a + 256]]
                for i, spans in enumerate(scan_texts(raws, scanner)):
                    if spans:
                        changed[a + i] = bodies[a + i] = masked(raws[i], spans)
            if changed:
                b = b.set_column(at, b.schema.field(at), pa.array(bodies, b.schema.field(at).type))
                if (c := b.schema.get_field_index(n_chars)) >= 0:
                    sizes = b.column(c).to_pylist()
                    for i, body in changed.items():
                        sizes[i] = len(body)
                    b = b.set_column(c, b.schema.field(c), pa.array(sizes, b.schema.field(c).type))
            yield b

    ship_package(df.sparkSession)
    return df.mapInArrow(run, df.schema)
