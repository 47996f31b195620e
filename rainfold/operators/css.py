"""ARMA fits by conditional sum of squares.

The residuals of an ARMA(p, q) follow a recursion, e_t = z_t - c - Σ a_i z_{t-i} -
Σ b_j e_{t-j}, and so do their derivatives by every parameter.  Both are linear in
the state before, so a stretch of positions maps the state at its start to the one
at its end by a matrix and a vector, and stretches compose: an associative scan.

* A series is cut into blocks of positions (``lagsums.blocks``), a block into short
  stretches.  All stretches of a batch step through their positions side by side in
  numpy, once from a zero state to get each stretch's vector, and once more from
  their true states; so no Python loop runs over a series.
* Series of several blocks get each block's vector first; a fold over the blocks
  gives every block its start.
* A series of one block is fitted in one task, all rounds of Levenberg–Marquardt at
  once.  For longer ones each round is one pass over the blocks of the fits that
  aren't done; sums of squares and products (8 × 8 a fit) are all that is shuffled.

Residuals of the first ``MAX_P`` positions are zero for every order, so that orders
compare on the same positions.  A step to a fit that isn't stationary and
invertible, or to a larger sum of squares, isn't taken, so a fit is never worse
than its start.  A missing value in a series raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import lagsums as S
from . import timeseries as T

#: Lags of the recursion, and its values: e and its derivatives by c, a1…, b1….
DEPTH = max(T.MAX_P, T.MAX_Q)
PARAMS = 1 + T.MAX_P + T.MAX_Q
VALUES = 1 + PARAMS
STATE = DEPTH * VALUES
#: Positions of a stretch, and positions that a worker steps through at a time.
STRETCH = 256
CHUNK = 1 << 20
#: Rounds at most; a fit ends when a round gains, or the next can gain, less than this share.
ROUNDS = 60
GAIN = 1e-15

CONTEXT = DEPTH + T.MAX_D
FIT = ("series string, p int, q int, d int, mu double, trial array<double>, theta array<double>, lam double, rss double, start_rss double, "
       "products array<double>, n long, active boolean")
RESULT = "series string, p int, q int, n long, const double, ar array<double>, ma array<double>, sigma2 double, aic double, start_aic double, ok boolean"


# --------------------------------------------------------------------------
# the recursion
# --------------------------------------------------------------------------

def _step_matrix(b: np.ndarray) -> np.ndarray:
    """How the state (values at three lags) moves without input, for each row of b."""
    m = np.zeros((len(b), STATE, STATE))
    for v in range(VALUES):
        for j in range(T.MAX_Q):
            m[:, v, j * VALUES + v] = -b[:, j]
    for k in range(T.MAX_Q):
        m[:, 2 + T.MAX_P + k, k * VALUES] -= 1.0
    low = np.arange(STATE - VALUES)
    m[:, VALUES + low, low] = 1.0
    return m


def _run(z: np.ndarray, theta: np.ndarray, state: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Values (rows, steps, VALUES) of stretches ``z`` (rows, DEPTH + steps) from
    their states; a row's first ``skip`` positions have zero values."""
    rows, steps = len(z), z.shape[1] - DEPTH
    c, a, b = theta[:, 0], theta[:, 1:1 + T.MAX_P], theta[:, 1 + T.MAX_P:]
    out = np.zeros((rows, steps, VALUES))
    last = [state[:, j * VALUES:(j + 1) * VALUES] for j in range(DEPTH)]
    for t in range(steps):
        now = -sum(b[:, j:j + 1] * last[j] for j in range(T.MAX_Q))
        past = z[:, t:t + DEPTH][:, ::-1]
        now[:, 0] += z[:, t + DEPTH] - c - (a * past[:, :T.MAX_P]).sum(1)
        now[:, 1] -= 1.0
        now[:, 2:2 + T.MAX_P] -= past[:, :T.MAX_P]
        for k in range(T.MAX_Q):
            now[:, 2 + T.MAX_P + k] -= last[k][:, 0]
        now[t < skip] = 0.0
        out[:, t] = now
        last = [now, *last[:-1]]
    return out


class _Stretches:
    """The blocks of a chunk, each cut into stretches, with their parameters."""

    def __init__(self, z: list[np.ndarray], own: list[int], theta: np.ndarray, skip: list[int]):
        self.many = np.array([-(-n // STRETCH) for n in own])
        self.first = np.concatenate([[0], np.cumsum(self.many)])
        self.block = np.repeat(np.arange(len(z)), self.many)
        self.z = np.zeros((self.first[-1], DEPTH + STRETCH))
        self.size = np.zeros(self.first[-1], int)
        self.skip = np.zeros(self.first[-1], int)
        for i, (v, n) in enumerate(zip(z, own, strict=True)):
            for s in range(self.many[i]):
                part = v[s * STRETCH:s * STRETCH + DEPTH + STRETCH]
                self.z[self.first[i] + s, :len(part)] = part
                self.size[self.first[i] + s] = min(STRETCH, n - s * STRETCH)
            if n:
                self.skip[self.first[i]] = skip[i]
        self.theta = theta

    def _ends(self, values: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The state after each stretch's last position."""
        whole = np.concatenate([state.reshape(-1, DEPTH, VALUES)[:, ::-1], values], 1)
        at = (self.size + DEPTH - 1)[:, None] - np.arange(DEPTH)[None, :]
        return whole[np.arange(len(whole))[:, None], at].reshape(-1, STATE)

    def solve(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all stretches, and each block's end state."""
        theta = self.theta[self.block]
        states = np.zeros((len(self.block), STATE))
        states[self.first[:-1]] = start
        if (self.many > 1).any():
            zero = np.zeros_like(states)
            vector = self._ends(_run(self.z, theta, zero, self.skip), zero)
            power = np.linalg.matrix_power(_step_matrix(self.theta[:, 1 + T.MAX_P:]), STRETCH)
            for s in range(1, int(self.many.max())):
                at = np.flatnonzero(self.many > s)
                before = self.first[at] + s - 1
                states[before + 1] = np.einsum("bij,bj->bi", power[at], states[before]) + vector[before]
        values = _run(self.z, theta, states, self.skip)
        return values, self._ends(values, states)[self.first[1:] - 1]


def _chunks(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, _Stretches]]:
    """Rows whose values come to about ``CHUNK``, as stretches of Δ^d y - mu."""
    sizes = pdf["y"].map(len).to_numpy()
    group = (np.cumsum(sizes) - sizes) // CHUNK
    for g in np.unique(group):
        part = pdf[group == g].reset_index(drop=True)
        z, own, skip = [], [], []
        for r in part.itertuples(index=False):
            whole = np.concatenate([np.asarray(r.before, float), np.asarray(r.y, float)])
            diffs = np.diff(whole, r.d) - r.mu
            n = len(r.y) if r.block else max(len(r.y) - r.d, 0)
            diffs = diffs[-(n + DEPTH):] if n else diffs[:0]
            z.append(np.concatenate([np.zeros(max(n + DEPTH - len(diffs), 0)), diffs]))
            own.append(n)
            skip.append(0 if r.block else T.MAX_P)
        yield part, _Stretches(z, own, np.stack([np.asarray(t, float) for t in part["trial"]]), skip)


def _block_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part, s in _chunks(pdf):
            _, ends = s.solve(np.zeros((len(part), STATE)))
            yield part[["series", "p", "q", "block", "trial"]].assign(size=part["y"].map(len), ends=list(ends))


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of every block of a fit, block after block."""
    pdf = pdf.sort_values("block")
    step = _step_matrix(np.asarray(pdf["trial"].iloc[0], float)[None, 1 + T.MAX_P:])[0]
    powers, state, out = {}, np.zeros(STATE), []
    for size, end in zip(pdf["size"], pdf["ends"], strict=True):
        out.append(state)
        if size not in powers:
            powers[size] = np.linalg.matrix_power(step, int(size))
        state = powers[size] @ state + np.asarray(end, float)
    return pd.DataFrame({"series": pdf["series"], "p": pdf["p"], "q": pdf["q"], "block": pdf["block"], "start": out})


def _block_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part, s in _chunks(pdf):
            start = np.stack([np.zeros(STATE) if v is None else np.asarray(v, float) for v in part["start"]])
            values, _ = s.solve(start)
            at = np.arange(STRETCH)[None, :]
            values *= ((at < s.size[:, None]) & (at >= s.skip[:, None]))[:, :, None]
            each = values.transpose(0, 2, 1) @ values
            sums = np.add.reduceat(each, s.first[:-1], axis=0) if len(each) else np.zeros((0, VALUES, VALUES))
            used = np.add.reduceat(np.maximum(s.size - s.skip, 0), s.first[:-1])
            yield part[["series", "p", "q", "block"]].assign(n=used, g=list(sums.reshape(-1, VALUES * VALUES)))


# --------------------------------------------------------------------------
# Levenberg–Marquardt, one pass a round
# --------------------------------------------------------------------------

def _next(pdf: pd.DataFrame) -> pd.DataFrame:
    """What a round's sums make of its fits: trials that gain are taken, and the
    next trial is solved from the products at the best parameters so far."""
    trial, theta = (np.stack([np.asarray(v, float) for v in pdf[c]]) for c in ("trial", "theta"))
    kept, g = (np.stack([np.asarray(v, float) for v in pdf[c]]).reshape(-1, VALUES, VALUES) for c in ("products", "g"))
    old, lam, rss = pdf["rss"].to_numpy(float), pdf["lam"].to_numpy(float).copy(), g[:, 0, 0]
    gained = np.isfinite(rss) & (rss < old)
    done = gained & np.isfinite(old) & (old - rss <= GAIN * old)
    theta = np.where(gained[:, None], trial, theta)
    kept = np.where(gained[:, None, None], g, kept)
    best = np.where(gained, rss, old)
    lam = np.where(gained, lam / 10, lam * 10)
    p, q = pdf["p"].to_numpy(int), pdf["q"].to_numpy(int)
    at = np.arange(PARAMS)[None, :]
    used = (at == 0) | ((at >= 1) & (at <= p[:, None])) | ((at > T.MAX_P) & (at <= T.MAX_P + q[:, None]))
    both = used[:, :, None] & used[:, None, :]
    eye = np.eye(PARAMS)[None]
    a = np.where(both, kept[:, 1:, 1:], 0.0) + eye * ~used[:, :, None]
    rhs = np.where(used, -kept[:, 1:, 0], 0.0)
    trial = theta.copy()
    open_ = ~done & np.isfinite(best) & (best > 0)
    for _ in range(12):
        todo = np.flatnonzero(open_ & (trial == theta).all(1) & (lam < 1e10))
        if not len(todo):
            break
        damped = a[todo] + eye * np.einsum("bii->bi", a[todo])[:, :, None] * lam[todo, None, None]
        ok = T._solvable(damped)
        step = np.zeros((len(todo), PARAMS))
        step[ok] = np.linalg.solve(damped[ok], rhs[todo][ok][:, :, None])[:, :, 0]
        ended = ok & (np.einsum("bi,bi->b", step, rhs[todo]) <= GAIN * best[todo])
        open_[todo[ended]] = False
        new = theta[todo] + step
        fine = ok & T._stationary(new[:, 1:1 + T.MAX_P]) & T._stationary(-new[:, 1 + T.MAX_P:])
        trial[todo[fine]] = new[fine]
        lam[todo[~fine & ~ended]] *= 10
    moves = open_ & (trial != theta).any(1)
    first = pdf["start_rss"].to_numpy(float)
    return pdf[["series", "p", "q", "d", "mu"]].assign(
        trial=list(trial), theta=list(theta), lam=lam, rss=best, start_rss=np.where(np.isfinite(first), first, rss),
        products=list(kept.reshape(-1, VALUES * VALUES)), n=pdf["used"].to_numpy(np.int64), active=moves)


def _round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield _next(pdf)


def _alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All rounds of fits whose series is one block, side by side in the task."""
    for pdf in batches:
        left = pdf.assign(start=None)
        for turn in range(ROUNDS):
            if not len(left):
                break
            sums = pd.concat(_block_sums(iter([left])), ignore_index=True)
            new = _next(left.reset_index(drop=True).assign(used=sums["n"], g=sums["g"]))
            on = new["active"].to_numpy() & (turn + 1 < ROUNDS)
            yield new[~on]
            left = pd.concat([left[["before", "y", "block", "start"]].reset_index(drop=True), new], axis=1)[on].reset_index(drop=True)


def _padded(values: str, size: int):
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.coalesce(F.try_element_at(F.col(values), i.cast("int")), F.lit(0.0)))


def _same(extra: tuple[str, ...] = ()):
    out = F.col("series").eqNullSafe(F.col("_series"))
    for c in ("p", "q", *extra):
        out &= F.col(c) == F.col(f"_{c}")
    return out


def _keyed(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in ("series", "p", "q", *more)], *[c for c in df.columns if c not in ("series", "p", "q", *more)])


def _evaluated(cut: DataFrame, fits: DataFrame) -> DataFrame:
    """Sums of products at each fit's trial parameters, (series, p, q, used, g)."""
    asked = fits.select(F.col("series").alias("_series"), "p", "q", "d", "mu", "trial")
    rows = cut.join(asked, F.col("series").eqNullSafe(F.col("_series"))).drop("_series", "last")
    ends = rows.mapInPandas(_block_ends, "series string, p int, q int, block long, trial array<double>, size long, ends array<double>")
    starts = materialize(ends.groupBy("series", "p", "q").applyInPandas(_starts, "series string, p int, q int, block long, start array<double>"), "css-starts")
    rows = rows.join(_keyed(starts, "block"), _same(("block",)), "left").drop("_series", "_p", "_q", "_block")
    sums = rows.mapInPandas(_block_sums, "series string, p int, q int, block long, n long, g array<double>")
    zero = F.array_repeat(F.lit(0.0), VALUES * VALUES)
    return sums.groupBy("series", "p", "q").agg(F.sum("n").alias("used"), F.array_sort(F.collect_list(F.struct("block", "g"))).alias("all")).select(
        "series", "p", "q", "used", F.aggregate("all", zero, lambda acc, x: F.zip_with(acc, x["g"], lambda u, v: u + v)).alias("g"))


def cut(series_idx: DataFrame, block_rows: int = S.BLOCK_ROWS) -> DataFrame:
    """The blocks that ``fit`` reads, written once."""
    return materialize(S.blocks(series_idx, CONTEXT, block_rows), "css-blocks")


def fit(blocks: DataFrame, start: DataFrame) -> DataFrame:
    """Fits of the orders in ``start`` (series, p, q, d, mu, const, ar, ma; null or
    unusable coefficients start from zero): ``RESULT``, AIC on equal positions."""
    ship_package(blocks.sparkSession)
    usable = F.col("ok") if "ok" in start.columns else F.col("const").isNotNull()
    theta = F.when(F.coalesce(usable, F.lit(False)), F.concat(F.array(F.coalesce("const", F.lit(0.0))), _padded("ar", T.MAX_P), _padded("ma", T.MAX_Q))).otherwise(
        F.array_repeat(F.lit(0.0), PARAMS))
    inf = F.lit(float("inf"))
    first = start.select("series", "p", "q", "d", "mu", theta.alias("trial"), theta.alias("theta"), F.lit(1e-6).alias("lam"), inf.alias("rss"), inf.alias("start_rss"),
                         F.array_repeat(F.lit(0.0), VALUES * VALUES).alias("products"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("active"))
    length = blocks.groupBy(F.col("series").alias("_series")).agg(F.max("block").alias("last_block"))
    fits = materialize(first.join(length, F.col("series").eqNullSafe(F.col("_series"))).drop("_series"), "css-fits")
    one = fits.filter("last_block = 0").drop("last_block").withColumnRenamed("series", "_series")
    alone = blocks.drop("last").join(one, F.col("series").eqNullSafe(F.col("_series"))).drop("_series")
    out = materialize(alone.mapInPandas(_alone, FIT), "css-fits")
    fits = fits.filter("last_block > 0").drop("last_block")
    for _ in range(ROUNDS):
        if fits.isEmpty():
            break
        fits = materialize(fits.drop("n").join(_keyed(_evaluated(blocks, fits)), _same()).drop("_series", "_p", "_q").mapInPandas(_round, FIT), "css-fits")
        out = out.unionByName(fits.filter("NOT active"))
        fits = fits.filter("active")
    out = out.unionByName(fits)
    known = F.col("rss").between(1e-300, 1e300) & (F.col("n") > F.col("p") + F.col("q") + 1)
    aic = lambda rss: F.when(known, F.col("n") * F.log(rss / F.col("n")) + 2.0 * (F.col("p") + F.col("q") + 2))
    return out.select("series", "p", "q", "n", F.col("theta")[0].alias("const"), F.slice("theta", 2, F.col("p")).alias("ar"),
                      F.slice("theta", 2 + T.MAX_P, F.col("q")).alias("ma"), F.when(known, F.col("rss") / F.col("n")).alias("sigma2"),
                      aic(F.col("rss")).alias("aic"), aic(F.col("start_rss")).alias("start_aic"), known.alias("ok"))
