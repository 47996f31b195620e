"""ARIMA models from lag sums that grow with the series.

All that the order search needs of a series is linear in the rows
``(1, y_t, y_{t-1}, …, y_{t-K})``: differences, lags, and the residuals of the long
autoregression, which are the regressors of the second stage.  So one matrix of
their summed products per series (its **lag sums**) gives the unit-root tests, the
means, both stages of the Hannan–Rissanen fit at every order, and the start of the
forecasts, and no other pass over the rows is made.

Lag sums are mergeable.  A series is cut into blocks of positions, each with the
last K values before it; a block's sums come from one matrix product around the
block's own mean, and sums around other means are moved by a linear map.  A stored
state (``summary``) also keeps the first and the last K values, so ``extend`` takes
new rows of a series into account without reading its old ones, and the result is
that of a summary of all rows.

Rules of the fit (differencing, singular systems, fallback) are those of
``timeseries``; ``grid`` returns the same candidates as ``timeseries.fit_grid``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import timeseries as T

#: Lags in the sums: the long autoregression, the residuals' lags and two differences.
LAGS = T.LONG_AR + max(T.MAX_P, T.MAX_Q) + T.MAX_D
WIDE = LAGS + 2
#: Positions a block holds.
BLOCK_ROWS = 100_000

#: n: values; last: the last position; base: what the sums are centred on; head, tail: the first and last
#: LAGS values, oldest first; low, high: the range of y, Δy and Δ²y; sums: the
#: products of ``BASIS`` rows of y - base, over positions beyond LAGS.
STATE = ("series string, n long, last long, base double, head array<double>, tail array<double>, low array<double>, high array<double>, "
         "total double, sums array<double>")


# --------------------------------------------------------------------------
# blocks and their sums
# --------------------------------------------------------------------------

def blocks(series_idx: DataFrame, context: int = LAGS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(series, block, before, y, last)``: the values of every block of positions
    in order, up to ``context`` values before them, and the last position.

    Rows are dealt by (series, block), so a long series spreads over many tasks.
    A missing value (null, NaN) raises: drop such rows before positions are numbered.
    """
    if context >= block_rows:
        raise ValueError("blocks must be longer than their context")
    at = "(idx - 1)"
    entries = (f"concat(array(named_struct('block', {at} div {block_rows}, 'own', true)), CASE WHEN {at} % {block_rows} >= {block_rows - context} "
               f"THEN array(named_struct('block', {at} div {block_rows} + 1, 'own', false)) ELSE array() END)")
    value = "CASE WHEN y IS NULL OR isnan(y) THEN raise_error('missing value in a series') ELSE CAST(y AS DOUBLE) END AS y"
    rows = series_idx.selectExpr("series", "idx", value, f"explode({entries}) AS e").select("series", "idx", "y", "e.*")
    got = rows.groupBy("series", "block").agg(F.array_sort(F.collect_list(F.struct("idx", "y", "own"))).alias("v"))
    own, before = F.filter("v", lambda x: x["own"]), F.filter("v", lambda x: ~x["own"])
    return got.select("series", "block", F.transform(before, lambda x: x["y"]).alias("before"), F.transform(own, lambda x: x["y"]).alias("y"),
                      F.try_element_at(own, F.lit(-1))["idx"].alias("last")).filter(F.size("y") > 0)


def _basis() -> np.ndarray:
    """(1, y_t, Δy_t, Δ²y_t, Δ²y_{t-1}, …) from (1, y_t, …, y_{t-LAGS}).  Sums of
    these keep their digits where the values drift far from their mean."""
    out = np.zeros((WIDE, WIDE))
    out[0, 0] = out[1, 1] = out[2, 1] = 1.0
    out[2, 2] = -1.0
    for j in range(LAGS - 1):
        out[3 + j, 1 + j:4 + j] = 1.0, -2.0, 1.0
    return out


BASIS = _basis()
#: The way back, all whole numbers.
BACK = np.rint(np.linalg.inv(BASIS))


def _lag_rows(y: np.ndarray) -> np.ndarray:
    """``BASIS`` rows for every position that has all lags."""
    if len(y) <= LAGS:
        return np.zeros((0, WIDE))
    second = np.lib.stride_tricks.sliding_window_view(np.diff(y, 2), LAGS - 1)[:, ::-1]
    return np.hstack([np.ones((len(second), 1)), y[LAGS:, None], np.diff(y)[LAGS - 1:, None], second])


def _ranges(y: np.ndarray, fresh: int) -> tuple[list[float], list[float]]:
    """The range of y, Δy and Δ²y over the last ``fresh`` positions."""
    low, high = [], []
    for d in range(T.MAX_D + 1):
        z = np.diff(y, d)[-fresh:] if fresh else np.zeros(0)
        low.append(float(z.min()) if len(z) else np.inf)
        high.append(float(z.max()) if len(z) else -np.inf)
    return low, high


def _moved(sums: np.ndarray, base: float, to: float) -> np.ndarray:
    """Lag sums around another base."""
    move = np.eye(WIDE)
    move[1, 0] = base - to
    return move @ sums @ move.T


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A state for each block, of its own positions."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            own, before = np.asarray(r.y, float), np.asarray(r.before, float)
            whole = np.concatenate([before, own])
            base = float(own.mean())
            rows = _lag_rows(whole - base)
            low, high = _ranges(whole, len(own))
            out.append((r.series, r.block, len(own), r.last, base, own[:LAGS] if r.block == 0 else [], whole[-LAGS:], low, high, float(own.sum()), (rows.T @ rows).ravel()))
        yield pd.DataFrame(out, columns=["series", "block", "n", "last", "base", "head", "tail", "low", "high", "total", "sums"])


def _folded(pdf: pd.DataFrame) -> pd.DataFrame:
    """States of consecutive parts of a series as one."""
    pdf = pdf.sort_values("block")
    n, last = int(pdf["n"].sum()), pdf.iloc[-1]
    base = float(pdf["total"].sum()) / n
    sums = sum(_moved(np.asarray(s, float).reshape(WIDE, WIDE), b, base) for s, b in zip(pdf["sums"], pdf["base"], strict=True))
    head = np.concatenate([np.asarray(h, float) for h in pdf["head"]])[:LAGS]
    return pd.DataFrame({"series": [last["series"]], "n": [n], "last": [int(pdf["last"].max())], "base": [base], "head": [head], "tail": [np.asarray(last["tail"], float)],
                         "low": [np.min(np.stack(pdf["low"]), axis=0)], "high": [np.max(np.stack(pdf["high"]), axis=0)],
                         "total": [float(pdf["total"].sum())], "sums": [sums.ravel()]})


PART = STATE.replace("series string,", "series string, block long,")


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("series").applyInPandas(_folded, STATE)


def summary(series_idx: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The state of every series of ``(series, idx, y)`` with positions 1, 2, …"""
    ship_package(series_idx.sparkSession)
    return _merged(blocks(series_idx, LAGS, block_rows).mapInPandas(_summed, PART))


def extend(state: DataFrame, more: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The state with ``more`` rows ``(series, idx, y)``, whose positions go on where
    the state's series end (new series start at 1).  Only the new rows are read:
    the state's last values stand for the old ones.
    """
    ship_package(more.sparkSession)
    old = state.select(F.col("series").alias("_series"), F.col("last").alias("_last"), F.col("tail").alias("_tail"))
    same = F.col("series").eqNullSafe(F.col("_series"))
    placed = more.select("series", "idx", "y").join(old.select("_series", "_last"), same, "left")
    cut = blocks(placed.select("series", (F.col("idx") - F.coalesce("_last", F.lit(0))).alias("idx"), "y"), LAGS, block_rows)
    none = F.array().cast("array<double>")
    parts = cut.join(old, same, "left").select(
        "series", "block", F.when(F.col("block") == 0, F.coalesce("_tail", none)).otherwise(F.col("before")).alias("before"), "y",
        (F.col("last") + F.coalesce("_last", F.lit(0))).alias("last"))
    kept = state.select("series", F.lit(-1).cast("long").alias("block"), *[c for c in state.columns if c != "series"])
    return _merged(kept.unionByName(parts.mapInPandas(_summed, PART)))


# --------------------------------------------------------------------------
# fits from the sums
# --------------------------------------------------------------------------

class _Batch:
    """The states of a batch of series as stacked arrays."""

    def __init__(self, pdf: pd.DataFrame):
        self.n = pdf["n"].to_numpy(np.int64)
        self.base = pdf["base"].to_numpy(float)
        self.sums = np.stack([np.asarray(s, float) for s in pdf["sums"]]).reshape(-1, WIDE, WIDE)
        self.head, self.tail = (np.stack([self._fill(v, back) for v in pdf[c]]) for c, back in (("head", False), ("tail", True)))
        self.low, self.high = (np.stack([np.asarray(v, float) for v in pdf[c]]) for c in ("low", "high"))
        self.total = pdf["total"].to_numpy(float)
        # the first positions' rows, which the sums leave out; lags they lack are 0 and not to be used
        self.early = np.zeros((len(pdf), LAGS, WIDE))
        self.early[:, :, 0] = 1.0
        for t in range(LAGS):
            self.early[:, t, 1:t + 2] = self.head[:, t::-1] - self.base[:, None]

    @staticmethod
    def _fill(values, back: bool) -> np.ndarray:
        v, out = np.asarray(values, float), np.zeros(LAGS)
        at = LAGS - len(v) if back else 0
        out[at:at + len(v)] = v
        return out

    def gram(self, rows: np.ndarray, need: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed products of linear combinations (series, k, WIDE) over all
        positions with ``need`` lags, and their number."""
        at = np.arange(1, LAGS + 1)[None, :]
        use = (at > np.broadcast_to(need, self.n.shape)[:, None]) & (at <= self.n[:, None])
        x = np.einsum("bkw,btw->btk", rows, self.early * use[:, :, None])
        known = rows @ BACK
        out = known @ self.sums @ known.transpose(0, 2, 1) + x.transpose(0, 2, 1) @ x
        return out, np.maximum(self.n - LAGS, 0) + use.sum(1)

    def row(self, lags: dict[int, float] | None = None, one: np.ndarray | float = 0.0) -> np.ndarray:
        out = np.zeros((len(self.n), WIDE))
        out[:, 0] = one
        for k, c in (lags or {}).items():
            out[:, 1 + k] += c
        return out


_DIFFS = {0: [1.0], 1: [1.0, -1.0], 2: [1.0, -2.0, 1.0]}


def _lagged(d: int, k: int, sign: float = 1.0, onto: dict[int, float] | None = None) -> dict[int, float]:
    """Coefficients of Δ^d y_{t-k} on y's lags."""
    out = dict(onto or {})
    for j, c in enumerate(_DIFFS[d]):
        out[k + j] = out.get(k + j, 0.0) + sign * c
    return out


def _unit_root(b: _Batch, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, beta, t, constant) of the augmented test of Δ^d y for each series."""
    lags = np.minimum(np.floor(np.maximum(b.n - 1, 0) ** (1 / 3) + 1e-9).astype(int), T.MAX_ADF_LAGS)
    step = lambda j: _lagged(d, j + 1, -1.0, _lagged(d, j))
    n, beta, t = np.zeros(len(b.n), np.int64), np.full(len(b.n), np.nan), np.full(len(b.n), np.nan)
    centre = b.total / np.maximum(b.n, 1) - b.base if d == 0 else np.zeros(len(b.n))
    for used in np.unique(lags):
        at = np.flatnonzero(lags == used)
        rows = np.stack([b.row(one=1.0), b.row(_lagged(d, 1), -centre), *[b.row(step(j)) for j in range(1, used + 1)], b.row(step(0))], 1)
        g, count = b.gram(rows, used + 1 + d)
        g, n[at] = g[at], count[at]
        ok = T._solvable(g[:, :-1, :-1])
        at, g = at[ok], g[ok]
        inv = T._inverse(g[:, :-1, :-1])
        coef = np.einsum("bij,bj->bi", inv, g[:, :-1, -1])
        rss = g[:, -1, -1] - np.einsum("bi,bi->b", coef, g[:, :-1, -1])
        beta[at] = coef[:, 1]
        dof = n[at] - coef.shape[1]
        fine = (dof > 0) & (rss > 0) & (inv[:, 1, 1] > 0)
        t[at[fine]] = coef[fine, 1] / np.sqrt(rss[fine] / dof[fine] * inv[fine, 1, 1])
    return n, beta, t, (b.n >= d + 2) & (b.low[:, d] == b.high[:, d])


def _orders(b: _Batch) -> tuple[np.ndarray, list[str]]:
    """The differencing order of each series, by the rules of ``timeseries.select_d``."""
    d, status = np.full(len(b.n), T.MAX_D), np.array(["tested"] * len(b.n), object)
    tests = [_unit_root(b, k) for k in range(T.MAX_D + 1)]
    for k in reversed(range(T.MAX_D + 1)):
        _, _, t, constant = tests[k]
        hit = (np.nan_to_num(t, nan=np.inf) < T.ADF_CRITICAL_5PCT) | constant
        d = np.where(hit, k, d)
        status = np.where(hit, np.where(constant, "constant", "tested"), status)
    short = (tests[0][0] < T.MIN_TEST_ROWS) & (status != "constant")
    return np.where(short, 0, d), np.where(short, "short", status)


STATE_COLUMNS = "d int, d_status string, mu double, zs array<double>, es array<double>, y_last double, dy_last double"
GRID = f"{T.GRID_SCHEMA}, {STATE_COLUMNS}"


def _candidates(b: _Batch, series: pd.Series, d: int, d_status: np.ndarray, wanted: np.ndarray) -> Iterator[pd.DataFrame]:
    """The wanted orders' fits of the series of one differencing order."""
    m, k = T.LONG_AR, max(T.MAX_P, T.MAX_Q)
    tail = b.tail
    # the mean of Δ^d y over all of them
    first = b.head
    if d == 0:
        mu = b.total / np.maximum(b.n, 1)
    else:
        top = tail[:, -1] if d == 1 else tail[:, -1] - tail[:, -2]
        low = first[:, 0] if d == 1 else first[:, 1] - first[:, 0]
        mu = np.where(b.n > d, (top - low) / np.maximum(b.n - d, 1), 0.0)
    one = (b.base - mu) if d == 0 else -mu
    z = [b.row(_lagged(d, j), one) for j in range(m + k + 1)]
    unit = b.row(one=1.0)

    g1, n1 = b.gram(np.stack([unit, *z[1:m + 1], z[0]], 1), m + d)
    a, _ = T._solved(g1, list(range(m + 1)), m + 1)
    a[~np.isfinite(a).all(1) | (n1 < m + 2)] = 0.0
    e = [z[j] - a[:, :1] * unit - sum(a[:, i:i + 1] * z[j + i] for i in range(1, m + 1)) for j in range(k + 1)]

    g2, n2 = b.gram(np.stack([unit, *z[1:T.MAX_P + 1], *e[1:T.MAX_Q + 1], z[0]], 1), m + k + d)
    spread, many = b.gram(z[0][:, None, :], d)
    mean, _ = b.gram(np.stack([unit, z[0]], 1), d)
    var = np.where(many > 0, np.maximum(spread[:, 0, 0] / np.maximum(many, 1) - (mean[:, 0, 1] / np.maximum(many, 1)) ** 2, 0.0), 0.0)

    # the start of the forecasts, from the last values
    now = np.ones((len(b.n), k, WIDE))
    for j in range(k):
        at = LAGS - 1 - j
        now[:, j, 1:] = 0.0
        now[:, j, 1:at + 2] = tail[:, at::-1] - b.base[:, None]
    # a value needs j + d predecessors, a residual m more; those without are unknown and 0
    enough = lambda need: b.n[:, None] > np.arange(k)[None, :] + need
    zs = np.where(enough(d), np.einsum("bw,bjw->bj", z[0], now), np.nan)
    es = np.where(enough(d + m), np.einsum("bw,bjw->bj", e[0], now), 0.0)
    state = pd.DataFrame({"d": np.full(len(b.n), d, np.int32), "d_status": d_status, "mu": mu, "zs": [[None if np.isnan(x) else x for x in v] for v in zs.tolist()],
                          "es": es.tolist(), "y_last": tail[:, -1], "dy_last": np.where(b.n > 1, tail[:, -1] - tail[:, -2], 0.0)})
    for p in range(T.MAX_P + 1):
        for q in range(T.MAX_Q + 1):
            at = np.flatnonzero(wanted[:, p, q])
            if len(at):
                fits = _fitted(g2[at], n2[at], p, q).assign(var=var[at])
                yield pd.concat([series.iloc[at].reset_index(drop=True), fits, state.iloc[at].reset_index(drop=True)], axis=1)


def _fitted(g: np.ndarray, n: np.ndarray, p: int, q: int) -> pd.DataFrame:
    """One order's fit of some series from the products of (1, z1…, e1…, z0)."""
    cols = [0, *range(1, p + 1), *range(1 + T.MAX_P, 1 + T.MAX_P + q)]
    coef, rss = T._solved(g, cols, 1 + T.MAX_P + T.MAX_Q)
    known = np.isfinite(coef).all(1) & (rss > 0) & (n > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        aic = n * np.log(rss / n) + 2.0 * (p + q + 2)
    ar, ma = coef[:, 1:1 + p], coef[:, 1 + p:]
    ok = known & (n > len(cols)) & T._stationary(ar) & T._stationary(-ma)
    put = lambda v: [x if k else None for x, k in zip(v.tolist(), known, strict=True)]
    return pd.DataFrame({"p": p, "q": q, "n": n, "const": put(coef[:, 0]), "ar": put(ar), "ma": put(ma), "sigma2": put(rss / np.maximum(n, 1)), "aic": put(aic), "ok": ok})


def _grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        d, status = _orders(_Batch(pdf))
        wanted = np.ones((len(pdf), T.MAX_P + 1, T.MAX_Q + 1), bool)
        if "wanted" in pdf:
            wanted[:] = False
            for i, orders in enumerate(pdf["wanted"]):
                for o in orders:
                    wanted[i, o["p"], o["q"]] = True
        for k in np.unique(d):
            part = pdf[d == k].reset_index(drop=True)
            yield from _candidates(_Batch(part), part["series"], int(k), status[d == k], wanted[d == k])


def _tests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        b = _Batch(pdf)
        for d in range(T.MAX_D + 1):
            n, beta, t, constant = _unit_root(b, d)
            out = pd.DataFrame({"series": pdf["series"], "d": d, "n": n, "beta": beta, "t_stat": t, "constant": constant})
            yield out.astype({"beta": object, "t_stat": object}).where(out.notna() | out.columns.isin(["series"])[None, :], None)


def unit_root_tests(state: DataFrame) -> DataFrame:
    """``(series, d, n, beta, t_stat, constant)`` as ``timeseries.adf_stats_augmented``."""
    return state.mapInPandas(_tests, "series string, d int, n long, beta double, t_stat double, constant boolean")


def grid(state: DataFrame) -> DataFrame:
    """All candidates of every series as ``timeseries.fit_grid``, each with the
    series' differencing order and the start of its forecasts."""
    ship_package(state.sparkSession)
    return state.mapInPandas(_grid, GRID)


def fit_orders(state: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows of ``grid`` for some orders ``(series, p, q)`` of some series only."""
    ship_package(state.sparkSession)
    asked = orders.groupBy(F.col("series").alias("_series")).agg(F.collect_set(F.struct("p", "q")).alias("wanted"))
    met = state.join(asked, F.col("series").eqNullSafe(F.col("_series"))).drop("_series")
    return met.mapInPandas(_grid, GRID)


def choose(candidates: DataFrame) -> DataFrame:
    """The model of every series in the layout that ``timeseries.forecast`` reads:
    the lowest AIC, or the fallback of ``timeseries.select_order``."""
    start = ["d", "d_status", "mu", "zs", "es", "y_last", "dy_last"]
    fixed = F.first(F.struct(*start)).alias("s")
    states = candidates.groupBy(F.col("series").alias("_series")).agg(fixed)
    best = T.select_order(candidates)
    drift = F.when((F.col("status") == "fallback") & (F.col("s.d") > 0), 0.0).otherwise(F.col("s.mu"))
    return best.join(states, F.col("series").eqNullSafe(F.col("_series"))).select(
        "series", "p", F.col("s.d").alias("d"), "q", "const", drift.alias("mu"), "ar", "ma", "sigma2", "aic", "n", "s.zs", "s.es", "s.y_last", "s.dy_last", "status")


def models(state: DataFrame) -> DataFrame:
    return choose(materialize(grid(state), "arima-grid"))
