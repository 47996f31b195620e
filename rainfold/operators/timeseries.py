"""Keyed time-series modelling: differencing order, ARIMA orders, forecasts.

Many series are modelled at once; every step is an aggregate per series or
an expression over a lag table, so the work spreads over the cluster and a
single huge series is no worse than many small ones:

* Lags come from key shifting (``shifted_lags``): a shuffle on
  ``(series, position)``, not a window over a whole series.  Only the narrow
  series and a small table of parameters per series are ever written; lag
  columns live inside the stage that aggregates them.
* Every series in is a series out: one too short, constant, or singular for
  the order search gets a stated fallback model and a ``status``.
* The unit-root (Dickey–Fuller) regression and AR(1) fits are ``regr_*``
  aggregates.
* ARMA(p, q) orders are fitted by the Hannan–Rissanen two-stage least squares
  method: stage 1 fits a long AR(m) from one Gram aggregate per series, its
  residuals become regressors, and stage 2 takes one 8 × 8 Gram aggregate per
  series that serves all 16 (p, q) candidates.  Only the tiny per-series
  systems are solved in a pandas function.
* Forecasts and their intervals are a fold (``aggregate`` over
  ``sequence(1, H)``) of built-in higher-order functions: recursion of the
  ARMA equation, ψ-weights for the variance, and integration for d = 1, 2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize as materialize_table
from ..session import ship_package
from .relational import shifted_lags

# 5 % critical value of the Dickey–Fuller t-test with constant
# and no trend (asymptotic), and the default search bounds of the order search.
ADF_CRITICAL_5PCT = -2.86
MAX_D = 2
MAX_P = 3
MAX_Q = 3
LONG_AR = 10
#: Lagged differences in the default unit-root test: floor((rows - 1)^(1/3)) of each series, this many at most.
MAX_ADF_LAGS = 8
#: Rows that a unit-root test needs; shorter series aren't differenced.
MIN_TEST_ROWS = 10
#: Forecast steps folded at a time.
FOLD_STEPS = 64


# --------------------------------------------------------------------------
# lag table and unit-root test
# --------------------------------------------------------------------------

def lag_table(df: DataFrame, key: str = "series", idx: str = "idx", y: str = "y", max_lag: int = 3) -> DataFrame:
    """``(key, idx, y, l1..l<max_lag>)`` by key shifting."""
    return shifted_lags(df.select(key, idx, y), key, idx, y, list(range(1, max_lag + 1)), prefix="l")


def _diff_sql(d: int, k: int, y: str = "y") -> str:
    """SQL text of z_{t-k} for differencing order d, from columns y (k = 0) and l<j>.

    Expressions are built as SQL text: one JVM call per expression instead of
    one per operator keeps plan construction fast with many lag columns.
    """
    def v(j):
        return y if j == 0 else f"l{j}"
    if d == 0:
        return v(k)
    if d == 1:
        return f"({v(k)} - {v(k + 1)})"
    if d == 2:
        return f"({v(k)} - 2.0 * {v(k + 1)} + {v(k + 2)})"
    raise ValueError("d must be 0, 1 or 2")


def _diff(d: int, k: int, y: str = "y") -> Column:
    return F.expr(_diff_sql(d, k, y))


def _t_stat(n: Column, sxx: Column, sxy: Column, syy: Column) -> Column:
    beta = F.try_divide(sxy, sxx)
    sse = syy - sxy * beta
    return F.try_divide(beta, F.sqrt(F.try_divide(F.try_divide(sse, (n - 2).cast("double")), sxx)))


def _unvarying(z: str, x: str) -> Column:
    """True if the pairs (z_t, z_{t-1}) show no variation at all."""
    return F.expr(f"coalesce(min({x}) FILTER (WHERE {z} IS NOT NULL) = max({x}) FILTER (WHERE {z} IS NOT NULL) "
                  f"AND min({z} - {x}) = 0 AND max({z} - {x}) = 0, false)")


def adf_stats(lagged: DataFrame, key: str = "series", max_d: int = MAX_D) -> DataFrame:
    """Dickey–Fuller regression Δz_t = α + β z_{t-1} for z = Δ^d y, d = 0..max_d.

    Returns ``(key, d, n, beta, t_stat, constant)``; all orders in one aggregate.
    ``constant``: z doesn't vary, so there is nothing to test.
    """
    aggs = []
    for d in range(max_d + 1):
        dz = _diff(d, 0) - _diff(d, 1)
        x = _diff(d, 1)
        aggs += [F.regr_count(dz, x).alias(f"n{d}"), F.regr_sxx(dz, x).alias(f"sxx{d}"),
                 F.regr_sxy(dz, x).alias(f"sxy{d}"), F.regr_syy(dz, x).alias(f"syy{d}"), _unvarying(_diff_sql(d, 0), _diff_sql(d, 1)).alias(f"c{d}")]
    sums = lagged.groupBy(key).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(d).alias("d"), F.col(f"n{d}").alias("n"),
                 F.try_divide(F.col(f"sxy{d}"), F.col(f"sxx{d}")).alias("beta"),
                 _t_stat(F.col(f"n{d}"), F.col(f"sxx{d}"), F.col(f"sxy{d}"), F.col(f"syy{d}")).alias("t_stat"),
                 F.col(f"c{d}").alias("constant"))
        for d in range(max_d + 1)]))
    return sums.select(key, rows.alias("r")).select(key, "r.*")


def _gram_stack(pdf: pd.DataFrame, names: list[str]) -> np.ndarray:
    """The rows' Gram matrices, (rows, k, k); missing sums are 0."""
    k = len(names)
    i, j = np.triu_indices(k)
    flat = pdf[[f"g__{names[a]}__{names[b]}" for a, b in zip(i, j)]].to_numpy(float)
    g = np.zeros((len(pdf), k, k))
    g[:, i, j] = g[:, j, i] = np.nan_to_num(flat)
    return g


def _scales(a: np.ndarray) -> np.ndarray:
    """What divides the matrices' entries so that their diagonals are 1."""
    scale = np.sqrt(np.maximum(np.einsum("bii->bi", a), 1e-300))
    return scale[:, :, None] * scale[:, None, :]


def _solvable(a: np.ndarray) -> np.ndarray:
    """Which of the (scaled) matrices are far from singular."""
    s = np.linalg.svd(a / _scales(a), compute_uv=False)
    return np.isfinite(s).all(1) & (s[:, -1] > 1e-12 * s[:, 0])


def _inverse(a: np.ndarray) -> np.ndarray:
    """Inverses by way of the scaled matrices: levels and differences may be
    many powers of ten apart, and unscaled that costs as many digits."""
    scale = _scales(a)
    return np.linalg.inv(a / scale) / scale


def _adf_solver(k: int):
    names = ["one", "x", *[f"g{j}" for j in range(1, k + 1)], "dz"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g, n, lags = _gram_stack(pdf, names), pdf["n"].to_numpy(float), pdf["lags"].to_numpy(int)
            beta, t = np.full(len(pdf), np.nan), np.full(len(pdf), np.nan)
            for used in np.unique(lags):
                at = np.flatnonzero(lags == used)
                cols = [*range(2 + used), len(names) - 1]
                part = g[at][:, cols][:, :, cols]
                ok = _solvable(part[:, :-1, :-1])
                at, part = at[ok], part[ok]
                inv = _inverse(part[:, :-1, :-1])
                b = np.einsum("bij,bj->bi", inv, part[:, :-1, -1])
                rss = part[:, -1, -1] - np.einsum("bi,bi->b", b, part[:, :-1, -1])
                beta[at] = b[:, 1]
                dof = n[at] - b.shape[1]
                fine = (dof > 0) & (rss > 0) & (inv[:, 1, 1] > 0)
                t[at[fine]] = b[fine, 1] / np.sqrt(rss[fine] / dof[fine] * inv[fine, 1, 1])
            out = pdf[["series", "d", "n", "constant"]].assign(beta=beta, t_stat=t)[["series", "d", "n", "beta", "t_stat", "constant"]]
            yield out.astype({"beta": object, "t_stat": object}).where(out.notna(), None)
    return run


def adf_stats_augmented(lagged: DataFrame, lags: int | None = None, key: str = "series", max_d: int = MAX_D) -> DataFrame:
    """Augmented Dickey–Fuller: Δz_t = α + β z_{t-1} + Σ_{j≤k} γ_j Δz_{t-j}.

    k is ``lags``, or by default floor((rows - 1)^(1/3)) of each series, at most
    ``MAX_ADF_LAGS``.  ``lagged`` needs y lags up to ``max_d + k + 1``.  Levels
    are centred per (series, d) first; one Gram aggregate per (series, d) and
    small solves, all of a batch at once, give β and its t-statistic.  Every
    series has a row for every d, with nulls where nothing can be tested.
    """
    most = MAX_ADF_LAGS if lags is None else lags
    need = max_d + most + 1
    if f"l{need}" not in lagged.columns:
        raise ValueError(f"lag table needs y lags up to {need} for d ≤ {max_d} and {most} lagged differences")
    ship_package(lagged.sparkSession)
    stats = lagged.groupBy(F.col(key).alias("_series")).agg(
        *([F.expr(f"least(CAST(floor(pow(greatest(count(y) - 1, 0), 1.0D / 3) + 1e-9) AS INT), {most}) AS lags")] if lags is None
          else [F.lit(lags).alias("lags")]),
        *[F.expr(f"avg({_diff_sql(d, 1)}) AS m{d}") for d in range(max_d + 1)],
        *[_unvarying(_diff_sql(d, 0), _diff_sql(d, 1)).alias(f"c{d}") for d in range(max_d + 1)])
    orders = []
    for d in range(max_d + 1):
        dz = [f"({_diff_sql(d, j)} - {_diff_sql(d, j + 1)})" for j in range(most + 1)]
        fields = [f"'d', {d}", f"'constant', c{d}", f"'x', {_diff_sql(d, 1)} - m{d}", f"'dz', {dz[0]}"]
        fields += [f"'g{j}', CASE WHEN {j} <= lags THEN {dz[j]} ELSE 0D END" for j in range(1, most + 1)]
        orders.append(f"named_struct({', '.join(fields)})")
    both = lagged.join(stats, F.col(key).eqNullSafe(F.col("_series")))
    rows = both.selectExpr(f"`{key}` AS series", "lags", f"inline(array({', '.join(orders)}))")
    names = ["one", "x", *[f"g{j}" for j in range(1, most + 1)], "dz"]
    full = " AND ".join(f"{c} IS NOT NULL" for c in names[1:])
    gram = rows.groupBy("series", "d", "lags", "constant").agg(*_gram_aggs(names, full))
    out = gram.mapInPandas(_adf_solver(most), "series string, d int, n long, beta double, t_stat double, constant boolean")
    return out.withColumnRenamed("series", key) if key != "series" else out


def select_d(adf: DataFrame, key: str = "series", critical: float = ADF_CRITICAL_5PCT,
             max_d: int = MAX_D) -> DataFrame:
    """``(key, d, d_status)``: the smallest d whose differenced series rejects a
    unit root or doesn't vary (``tested``, ``constant``), ``max_d`` if none, and 0
    for series with fewer than ``MIN_TEST_ROWS`` rows (``short``)."""
    hit = F.min(F.when((F.col("t_stat") < F.lit(critical)) | F.col("constant"), F.struct("d", "constant")))
    rows = F.coalesce(F.max(F.when(F.col("d") == 0, F.col("n"))), F.lit(0))
    out = adf.groupBy(key).agg(hit.alias("hit"), rows.alias("rows"))
    flat = F.coalesce(F.col("hit.constant"), F.lit(False))
    short = (F.col("rows") < MIN_TEST_ROWS) & ~flat
    return out.select(
        key, F.when(short, 0).otherwise(F.coalesce("hit.d", F.lit(max_d))).cast("int").alias("d"),
        F.when(flat, "constant").when(short, "short").otherwise("tested").alias("d_status"))


# --------------------------------------------------------------------------
# AR(1) in closed form
# --------------------------------------------------------------------------

def ar1_fit(lagged: DataFrame, key: str = "series") -> DataFrame:
    """y_t = c + φ y_{t-1} + e_t by least squares, with the last value per series."""
    y, x = F.col("y"), F.col("l1")
    n = F.regr_count(y, x)
    sxx, sxy, syy = F.regr_sxx(y, x), F.regr_sxy(y, x), F.regr_syy(y, x)
    return lagged.groupBy(key).agg(
        n.alias("n"), F.regr_slope(y, x).alias("phi"), F.regr_intercept(y, x).alias("c"),
        F.try_divide(syy - sxy * F.try_divide(sxy, sxx), (n - 2).cast("double")).alias("sigma2"),
        F.max_by("y", "idx").alias("y_last"),
    )


def ar1_as_model(fit: DataFrame, key: str = "series") -> DataFrame:
    """AR(1) fits in the general model layout used by ``forecast``."""
    return fit.select(
        key, F.lit(1).alias("p"), F.lit(0).alias("d"), F.lit(0).alias("q"),
        F.col("c").alias("const"), F.lit(0.0).alias("mu"),
        F.array("phi").alias("ar"), F.array().cast("array<double>").alias("ma"), "sigma2",
        F.array("y_last").alias("zs"), F.array().cast("array<double>").alias("es"),
        "y_last", F.lit(0.0).alias("dy_last"))


# --------------------------------------------------------------------------
# Hannan–Rissanen ARMA fitting
# --------------------------------------------------------------------------

def _gram_aggs(names: list[str], full: str) -> list[Column]:
    """``count`` and ``sum(a * b)`` for every pair of regressors over the rows
    where ``full`` holds (SQL text); groups without such rows stay, with nulls."""
    out = [F.expr(f"count_if({full}) AS n")]
    for i, a in enumerate(names):
        for b in names[i:]:
            ca = "1.0D" if a == "one" else a
            cb = "1.0D" if b == "one" else b
            out.append(F.expr(f"sum({ca} * {cb}) FILTER (WHERE {full}) AS g__{a}__{b}"))
    return out


def _stationary(coefs: np.ndarray) -> np.ndarray:
    """For each row c of coefficients: all roots of 1 - c1 x - … - ck x^k lie
    outside the unit circle (the companion matrix's eigenvalues inside it)."""
    n, k = coefs.shape
    if k == 0:
        return np.ones(n, bool)
    companion = np.zeros((n, k, k))
    companion[:, 0, :] = np.nan_to_num(coefs)
    companion[:, np.arange(1, k), np.arange(k - 1)] = 1.0
    return np.isfinite(coefs).all(1) & (np.abs(np.linalg.eigvals(companion)).max(1) < 1 / (1 + 1e-8))


def _solved(g: np.ndarray, cols: list[int], target: int) -> tuple[np.ndarray, np.ndarray]:
    """Least squares on some regressors, all rows at once: coefficients and the
    residual sum of squares, NaN where the system is singular."""
    beta = np.full((len(g), len(cols)), np.nan)
    a = g[:, cols][:, :, cols]
    ok = _solvable(a)
    beta[ok] = np.linalg.solve(a[ok], g[ok][:, cols, target][:, :, None])[:, :, 0]
    return beta, g[:, target, target] - np.einsum("bi,bi->b", beta, g[:, cols, target])


def _stage1_solver(names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = _gram_stack(pdf, names)
            a, _ = _solved(g, list(range(len(names) - 1)), len(names) - 1)
            bad = ~np.isfinite(a).all(1) | (pdf["n"].to_numpy() < len(names))
            a[bad] = 0.0  # the series itself then stands for its residuals
            yield pd.DataFrame({"series": pdf["series"], "a": list(a)})
    return run


def _stage2_solver(names: list[str], max_p: int, max_q: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g, n = _gram_stack(pdf, names), pdf["n"].to_numpy(float)
            target, parts = len(names) - 1, []
            for p in range(max_p + 1):
                for q in range(max_q + 1):
                    cols = [0, *range(1, p + 1), *range(1 + max_p, 1 + max_p + q)]
                    beta, rss = _solved(g, cols, target)
                    known = np.isfinite(beta).all(1) & (rss > 0) & (n > 0)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        aic = n * np.log(rss / n) + 2.0 * (p + q + 2)
                    ar, ma = beta[:, 1:1 + p], beta[:, 1 + p:]
                    ok = known & (n > len(cols)) & _stationary(ar) & _stationary(-ma)
                    put = lambda v: [x if k else None for x, k in zip(v, known, strict=True)]  # noqa: E731, B023
                    parts.append(pd.DataFrame({
                        "series": pdf["series"], "p": p, "q": q, "n": pdf["n"], "const": put(beta[:, 0].tolist()), "ar": put(ar.tolist()), "ma": put(ma.tolist()),
                        "sigma2": put((rss / np.maximum(n, 1)).tolist()), "aic": put(aic.tolist()), "ok": ok, "var": pdf["var"]}))
            yield pd.concat(parts)
    return run


GRID_SCHEMA = ("series string, p int, q int, n long, const double, ar array<double>, ma array<double>, "
               "sigma2 double, aic double, ok boolean, var double")


def prepare(series_idx: DataFrame, d_table: DataFrame | None = None, m: int = LONG_AR, max_p: int = MAX_P,
            max_q: int = MAX_Q, materialize: bool = True, adf_lags: int | None = None) -> DataFrame:
    """Lag table of the centred differenced series with stage-1 residual columns.

    Columns: series, idx, d, mu, y, l1, z0..z<m+max(p,q)> (centred Δ^d y at
    lags), e0..e<max(p,q)> (long-AR residuals at lags).  With ``materialize``
    the narrow series (series, idx, y) and a table of parameters per series (d,
    mean, stage-1 coefficients) are written to the shared checkpoint folder;
    the lag columns are made again by each of the stages that aggregate them.
    Without a ``d_table`` the differencing order comes from the augmented
    unit-root test on that same lag table (see ``adf_stats_augmented``).  A
    series that the long autoregression can't be fitted to has zero
    coefficients there.
    """
    k = max(max_p, max_q)
    n_lags = max(m + k + MAX_D, MAX_D + (MAX_ADF_LAGS if adf_lags is None else adf_lags) + 1)
    ship_package(series_idx.sparkSession)
    base = series_idx.select("series", "idx", "y")
    if materialize:
        base = materialize_table(base, "series")
    lag = lag_table(base, "series", "idx", "y", n_lags)
    if d_table is None:
        adf = adf_stats(lag, "series") if adf_lags == 0 else adf_stats_augmented(lag, adf_lags, "series")
        d_table = select_d(adf, "series")
        if materialize:
            d_table = materialize_table(d_table, "orders")

    def z(kk: int, centre: str = "") -> str:
        return (f"CASE d WHEN 0 THEN {_diff_sql(0, kk)} WHEN 1 THEN {_diff_sql(1, kk)} "
                f"ELSE {_diff_sql(2, kk)} END{centre} AS z{kk}")

    # Tables per series come out of shuffle aggregates; AQE measures them and
    # broadcasts only below its size threshold.
    orders = d_table.select(F.col("series").alias("_series"), F.col("d").alias("_d"))
    same = F.col("series").eqNullSafe(F.col("_series"))
    with_d = lag.join(orders, same, "left").withColumn("d", F.coalesce("_d", F.lit(0))).drop("_series", "_d")
    zr = with_d.selectExpr("series", "d", *[z(kk) for kk in range(m + 1)])
    # The mean centres the regressors of the Gram sums as well: sums of raw
    # products, less what the means make of them, would lose digits.
    mu = zr.groupBy("series", "d").agg(F.expr("coalesce(avg(z0), 0D) AS mu"))
    if materialize:
        mu = materialize_table(mu, "means")
    means = mu.select(F.col("series").alias("_series"), "mu")
    centred = zr.join(means, same).selectExpr("series", *[f"z{kk} - mu AS z{kk}" for kk in range(m + 1)])
    # stage 1: long AR(m) on the centred series
    names1 = ["one", *[f"z{kk}" for kk in range(1, m + 1)], "z0"]
    g1 = centred.groupBy("series").agg(*_gram_aggs(names1, f"z{m} IS NOT NULL AND z0 IS NOT NULL"))
    a = g1.mapInPandas(_stage1_solver(names1), "series string, a array<double>")
    params = mu.join(a.withColumnRenamed("series", "_series"), same).drop("_series")
    if materialize:
        params = materialize_table(params, "arma-params")
    t = lag.join(params.withColumnRenamed("series", "_series"), same).selectExpr(
        "series", "idx", "d", "mu", "a", "y", "l1", *[z(kk, " - mu") for kk in range(m + k + 1)])
    resid = [f"z{j} - a[0] - (" + " + ".join(f"a[{kk}] * z{j + kk}" for kk in range(1, m + 1)) + f") AS e{j}"
             for j in range(k + 1)]
    keep = ["series", "idx", "d", "mu", "y", "l1", *[f"z{kk}" for kk in range(m + k + 1)]]
    return t.selectExpr(*keep, *resid)


def fit_grid(prepared: DataFrame, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """All (p, q) candidates of every series from one stage-2 Gram aggregate;
    ``ok`` marks those that could be fitted, are stationary and invertible."""
    ship_package(prepared.sparkSession)
    names2 = ["one", *[f"z{i}" for i in range(1, max_p + 1)], *[f"e{j}" for j in range(1, max_q + 1)], "z0"]
    full = f"e{max_q} IS NOT NULL AND z{max_p} IS NOT NULL AND z0 IS NOT NULL"
    g2 = prepared.groupBy("series").agg(*_gram_aggs(names2, full), F.expr("coalesce(var_pop(z0), 0D) AS var"))
    return g2.mapInPandas(_stage2_solver(names2, max_p, max_q), GRID_SCHEMA)


def select_order(grid: DataFrame) -> DataFrame:
    """Lowest-AIC acceptable candidate of every series (``status`` ``fitted``); a
    series without one gets the mean model, or the last value where it is
    differenced (p = q = 0, ``status`` ``fallback``)."""
    fields = ["p", "q", "n", "const", "ar", "ma", "sigma2", "aic"]
    best = F.min_by(F.when(F.col("ok"), F.struct(*fields)), F.when(F.col("ok"), F.struct("aic", "p", "q")))
    out = grid.groupBy("series").agg(best.alias("b"), F.max("n").alias("rows"), F.max("var").alias("var"))
    none = F.array().cast("array<double>")
    plain = F.struct(F.lit(0).alias("p"), F.lit(0).alias("q"), F.col("rows").alias("n"), F.lit(0.0).alias("const"),
                     none.alias("ar"), none.alias("ma"), F.col("var").alias("sigma2"), F.lit(None).cast("double").alias("aic"))
    return out.select("series", F.coalesce("b", plain).alias("b"),
                      F.when(F.col("b").isNull(), "fallback").otherwise("fitted").alias("status")).select("series", "b.*", "status")


def last_state(prepared: DataFrame, k: int = max(MAX_P, MAX_Q)) -> DataFrame:
    """Forecast start per series: last centred values, residuals and levels."""
    st = F.struct(
        F.array(*[F.col(f"z{j}") for j in range(k)]).alias("zs"),
        F.array(*[F.coalesce(F.col(f"e{j}"), F.lit(0.0)) for j in range(k)]).alias("es"),
        F.col("y").alias("y_last"), F.coalesce(F.col("y") - F.col("l1"), F.lit(0.0)).alias("dy_last"),
        F.col("d").alias("d"), F.col("mu").alias("mu"))
    return prepared.groupBy("series").agg(F.max_by(st, "idx").alias("s")).select("series", "s.*")


def arima_models(prepared: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen orders with their forecast start: the layout ``forecast`` reads."""
    st = last_state(prepared).withColumnRenamed("series", "_series")
    drift = F.when((F.col("status") == "fallback") & (F.col("d") > 0), 0.0).otherwise(F.col("mu"))
    return chosen.join(st, F.col("series").eqNullSafe(F.col("_series"))).select(
        "series", "p", "d", "q", "const", drift.alias("mu"), "ar", "ma", "sigma2", "aic", "n", "zs", "es", "y_last", "dy_last", "status")


# --------------------------------------------------------------------------
# forecasting fold
# --------------------------------------------------------------------------

def dot(coefs: Column, hist: Column) -> Column:
    pairs = F.zip_with(coefs, F.slice(hist, 1, F.size(coefs)), lambda a, b: a * F.coalesce(b, F.lit(0.0)))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)


OUT_TYPE = "array<struct<h:int,yhat:double,se:double>>"


def fold(models: DataFrame, init: Column, step, horizon: int, out_type: str) -> tuple[DataFrame, Column]:
    """Fold ``step`` over 1..horizon from ``init`` in every row; the rows, and the
    records that the steps put into ``out``.

    Steps are folded a block at a time, so that the growing list of records
    that every step copies stays short.
    """
    block = max(FOLD_STEPS, math.isqrt(horizon))
    rows, state, outs = models.withColumn("_state", init), "_state", []
    for a in range(1, horizon + 1, block):
        steps = F.sequence(F.lit(a), F.lit(min(a + block - 1, horizon)))
        start = F.col(state).withField("out", F.array().cast(out_type))
        rows = rows.withColumn(f"_s{a}", F.aggregate(steps, start, step))
        state = f"_s{a}"
        outs.append(F.col(f"{state}.out"))
    return rows, F.concat(*outs)


def forecast(models: DataFrame, horizon: int, level: float = 0.95, key: str = "series") -> DataFrame:
    """``(key, h, yhat, se, lo, hi)`` for h = 1..horizon from each model row.

    Model columns: p, d, q, const (of the centred series), mu, ar, ma, sigma2,
    zs (last centred values, newest first), es (last residuals, newest
    first), y_last, dy_last.
    """
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    zq = NormalDist().inv_cdf(0.5 + level / 2.0)
    init = F.struct(
        F.col("zs").cast("array<double>").alias("zs"), F.col("es").cast("array<double>").alias("es"),
        F.col("y_last").cast("double").alias("lv"), F.col("dy_last").cast("double").alias("dv"),
        F.array().cast("array<double>").alias("psis"),
        F.lit(0.0).alias("c1"), F.lit(0.0).alias("c2"), F.lit(0.0).alias("ss"),
        F.array().cast(OUT_TYPE).alias("out"))
    d = F.col("d")

    def step(acc, h):
        zc = F.col("const") + dot(F.col("ar"), acc["zs"]) + dot(F.col("ma"), acc["es"])
        z = zc + F.col("mu")
        dv = F.when(d == 2, acc["dv"] + z).otherwise(acc["dv"])
        yhat = F.when(d == 0, z).when(d == 1, acc["lv"] + z).otherwise(acc["lv"] + dv)
        theta_j = F.coalesce(F.try_element_at(F.col("ma"), (h - 1).cast("int")), F.lit(0.0))
        psi = F.when(h == 1, F.lit(1.0)).otherwise(theta_j + dot(F.col("ar"), acc["psis"]))
        c1 = acc["c1"] + psi
        c2 = acc["c2"] + c1
        pstar = F.when(d == 0, psi).when(d == 1, c1).otherwise(c2)
        ss = acc["ss"] + pstar * pstar
        se = F.sqrt(F.col("sigma2") * ss)
        rec = F.struct(h.cast("int").alias("h"), yhat.alias("yhat"), se.alias("se"))
        return F.struct(
            F.slice(F.concat(F.array(zc), acc["zs"]), 1, 8).alias("zs"),
            F.slice(F.concat(F.array(F.lit(0.0)), acc["es"]), 1, 8).alias("es"),
            yhat.alias("lv"), dv.alias("dv"),
            F.slice(F.concat(F.array(psi), acc["psis"]), 1, 8).alias("psis"),
            c1.alias("c1"), c2.alias("c2"), ss.alias("ss"),
            F.concat(acc["out"], F.array(rec)).alias("out"))

    rows, outs = fold(models, init, step, horizon, OUT_TYPE)
    return rows.select(key, F.inline(outs)).select(
        key, F.col("h").cast("long").alias("h"), "yhat", "se",
        (F.col("yhat") - zq * F.col("se")).alias("lo"), (F.col("yhat") + zq * F.col("se")).alias("hi"))
