"""Recovery of known AR/MA coefficients and the forecast fold against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.operators import timeseries as T


def _arma(n, c=0.0, phi=(), theta=(), seed=0, burn=200):
    rng = np.random.default_rng(seed)
    e = rng.standard_normal(n + burn)
    y = np.zeros(n + burn)
    for t in range(n + burn):
        ar = sum(phi[i] * y[t - 1 - i] for i in range(len(phi)) if t - 1 - i >= 0)
        ma = sum(theta[j] * e[t - 1 - j] for j in range(len(theta)) if t - 1 - j >= 0)
        y[t] = c + ar + ma + e[t]
    return y[burn:]


def _frame(spark, named):
    rows = [(name, i + 1, float(v)) for name, ys in named.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "series string, idx long, y double")


@pytest.fixture(scope="module")
def synthetic(spark):
    named = {
        "ar1": _arma(4000, c=2.0, phi=(0.6,)),
        "ar2": _arma(4000, phi=(0.5, -0.3), seed=1),
        "ma1": _arma(4000, theta=(0.5,), seed=2),
        "arma11": _arma(4000, c=2.0, phi=(0.6,), theta=(0.4,), seed=3),
        "walk": np.cumsum(_arma(2000, seed=4)),
    }
    df = _frame(spark, named)
    prep = T.prepare(df).cache()
    grid = {(r["series"], r["p"], r["q"]): r for r in T.fit_grid(prep).collect()}
    return df, prep, grid


def test_ar1_closed_form(spark, synthetic):
    df, _, _ = synthetic
    fit = {r["series"]: r for r in T.ar1_fit(T.lag_table(df, max_lag=1)).collect()}
    assert abs(fit["ar1"]["phi"] - 0.6) < 0.03
    assert abs(fit["ar1"]["c"] / (1 - fit["ar1"]["phi"]) - 5.0) < 0.2


def test_select_d(spark, synthetic):
    df, _, _ = synthetic
    d = {r["series"]: r["d"] for r in T.select_d(T.adf_stats(T.lag_table(df, max_lag=3))).collect()}
    assert d["walk"] == 1
    assert d["ar1"] == 0 and d["arma11"] == 0


def test_recovers_coefficients(synthetic):
    _, _, grid = synthetic
    ar2 = grid[("ar2", 2, 0)]
    assert np.allclose(ar2["ar"], [0.5, -0.3], atol=0.05)
    ma1 = grid[("ma1", 0, 1)]
    assert np.allclose(ma1["ma"], [0.5], atol=0.06)
    arma = grid[("arma11", 1, 1)]
    assert np.allclose(arma["ar"], [0.6], atol=0.06) and np.allclose(arma["ma"], [0.4], atol=0.07)
    assert arma["ok"]


def test_order_selection_prefers_true_structure(synthetic):
    _, prep, grid = synthetic
    best = {}
    for (s, p, q), r in grid.items():
        if r["ok"] and (s not in best or r["aic"] < best[s]["aic"]):
            best[s] = r
    assert best["ar1"]["p"] >= 1
    assert (best["ar2"]["p"], best["ar2"]["q"]) in {(2, 0), (2, 1), (3, 0)}


def _numpy_forecast(const, mu, ar, ma, sigma2, zs, es, y_last, dy_last, d, H):
    zs, es = list(zs), list(es)
    lv, dv = y_last, dy_last
    out, psis, c1, c2, ss = [], [], 0.0, 0.0, 0.0
    for h in range(1, H + 1):
        zc = const + sum(a * zs[i] for i, a in enumerate(ar)) + sum(t * es[j] for j, t in enumerate(ma))
        z = zc + mu
        if d == 0:
            yhat = z
        elif d == 1:
            yhat = lv + z
        else:
            dv = dv + z
            yhat = lv + dv
        lv = yhat
        j = h - 1
        psi = 1.0 if h == 1 else (ma[j - 1] if j <= len(ma) else 0.0) + sum(
            a * psis[i] for i, a in enumerate(ar) if i < len(psis))
        psis.insert(0, psi)
        c1 += psi
        c2 += c1
        ps = psi if d == 0 else (c1 if d == 1 else c2)
        ss += ps * ps
        out.append((yhat, np.sqrt(sigma2 * ss)))
        zs.insert(0, zc)
        es.insert(0, 0.0)
    return out


@pytest.mark.parametrize("d", [0, 1, 2])
def test_fold_equals_numpy(spark, d):
    m = dict(series="s", p=2, d=d, q=2, const=0.3, mu=1.5, ar=[0.5, -0.2], ma=[0.4, 0.1], sigma2=2.0,
             zs=[0.7, -0.1, 0.2], es=[0.3, -0.5, 0.0], y_last=10.0, dy_last=0.8)
    df = spark.createDataFrame([m], "series string, p int, d int, q int, const double, mu double, ar array<double>, "
                                    "ma array<double>, sigma2 double, zs array<double>, es array<double>, "
                                    "y_last double, dy_last double")
    got = sorted((r["h"], r["yhat"], r["se"]) for r in T.forecast(df, 6).collect())
    want = _numpy_forecast(0.3, 1.5, [0.5, -0.2], [0.4, 0.1], 2.0, [0.7, -0.1, 0.2], [0.3, -0.5, 0.0],
                           10.0, 0.8, d, 6)
    for (h, yhat, se), (wy, ws) in zip(got, want):
        assert abs(yhat - wy) < 1e-9 and abs(se - ws) < 1e-9


def test_interval_contains_point(spark, synthetic):
    _, prep, grid = synthetic
    models = T.arima_models(prep, T.select_order(T.fit_grid(prep)))
    fc = T.forecast(models, 5).collect()
    assert len(fc) == 5 * 5
    assert all(r["lo"] < r["yhat"] < r["hi"] for r in fc)
    walk = sorted((r["h"], r["se"]) for r in fc if r["series"] == "walk")
    assert walk[-1][1] > walk[0][1] * 1.5  # integrated: variance grows with h


def test_augmented_adf_with_no_lags_equals_plain(spark, synthetic):
    df, _, _ = synthetic
    lag = T.lag_table(df, max_lag=5)
    plain = {(r["series"], r["d"]): r["t_stat"] for r in T.adf_stats(lag).collect()}
    aug0 = {(r["series"], r["d"]): r["t_stat"] for r in T.adf_stats_augmented(lag, 0).collect()}
    assert plain.keys() == aug0.keys()
    assert all(abs(plain[k] - aug0[k]) < 1e-6 for k in plain)
    aug2 = {r["series"]: r["d"] for r in T.select_d(T.adf_stats_augmented(lag, 2)).collect()}
    assert aug2["walk"] == 1 and aug2["ar1"] == 0


def test_model_table_roundtrip(spark, synthetic):
    from rainfold.session import scratch_path
    from rainfold.sources import models as MS

    _, prep, _ = synthetic
    models = T.arima_models(prep, T.select_order(T.fit_grid(prep))).cache()
    path = scratch_path(spark, "t-models")
    MS.save_forecast_models(models, path)
    a = sorted((r["series"], r["h"], round(r["yhat"], 9)) for r in T.forecast(models, 4).collect())
    b = sorted((r["series"], r["h"], round(r["yhat"], 9)) for r in
               T.forecast(MS.load_forecast_models(spark, path), 4).collect())
    assert a == b and len(a) == 20


def _awkward_series(spark):
    rnd = random.Random(5)
    rows = []
    for name, n, f in (("constant", 200, lambda i: 7.0), ("short", 12, lambda i: rnd.gauss(0, 1)), ("one", 1, lambda i: 3.0),
                       ("two", 2, lambda i: float(i)), ("noise", 300, lambda i: rnd.gauss(5, 2)), ("line", 100, lambda i: 2.0 * i), (None, 60, lambda i: rnd.gauss(0, 1))):
        rows += [(name, i + 1, f(i)) for i in range(n)]
    y = 0.0
    for i in range(300):
        y += rnd.gauss(0.2, 1)
        rows.append(("walk", i + 1, y))
    return spark.createDataFrame(rows, "series string, idx long, y double")


def test_no_series_is_lost(spark):
    df = _awkward_series(spark)
    prep = T.prepare(df)
    models = T.arima_models(prep, T.select_order(T.fit_grid(prep))).cache()
    got = {r["series"]: r for r in models.collect()}
    assert set(got) == {"constant", "short", "one", "two", "noise", "line", "walk", None}
    assert got["constant"]["d"] == 0 and got["constant"]["status"] == "fallback" and got["constant"]["mu"] == 7.0
    assert got["line"]["d"] == 1 and got["noise"]["d"] == 0 and got["walk"]["d"] == 1
    assert got["one"]["d"] == got["two"]["d"] == 0 and got["noise"]["status"] == "fitted"
    fc = {}
    for r in T.forecast(models, 5).collect():
        fc.setdefault(r["series"], []).append(r["yhat"])
    assert set(fc) == set(got) and all(len(v) == 5 and all(x is not None and math.isfinite(x) for x in v) for v in fc.values())
    assert fc["constant"] == [7.0] * 5 and fc["one"] == [3.0] * 5


def test_select_d_of_constant_line_and_short(spark):
    lag = T.lag_table(_awkward_series(spark), "series", "idx", "y", 11)
    for adf in (T.adf_stats(lag, "series"), T.adf_stats_augmented(lag)):
        got = {r["series"]: (r["d"], r["d_status"]) for r in T.select_d(adf, "series").collect()}
        assert got["constant"] == (0, "constant") and got["line"] == (1, "constant")
        assert got["one"] == got["two"] == (0, "short") and got["noise"] == (0, "tested")


def test_augmented_test_is_the_same_at_any_level(spark):
    rnd = random.Random(9)
    noise = [rnd.gauss(0, 1) for _ in range(400)]
    rows = [(name, i + 1, base + v) for name, base in (("low", 0.0), ("high", 1e7)) for i, v in enumerate(noise)]
    lag = T.lag_table(spark.createDataFrame(rows, "series string, idx long, y double"), "series", "idx", "y", 11)
    got = {(r["series"], r["d"]): r["t_stat"] for r in T.adf_stats_augmented(lag).collect()}
    for d in range(3):
        assert abs(got["low", d] - got["high", d]) < 1e-4 * abs(got["low", d])
    plain = {(r["series"], r["d"]): r["t_stat"] for r in T.adf_stats(lag).collect()}
    zero = {(r["series"], r["d"]): r["t_stat"] for r in T.adf_stats_augmented(lag, 0).collect()}
    assert all(abs(plain[k] - zero[k]) < 1e-4 * abs(plain[k]) for k in plain)


def test_long_horizons_fold_in_blocks(spark):
    models = spark.createDataFrame([("a", 1, 0, 0, 1.0, 0.0, [0.5], [], 2.0, [4.0], [], 4.0, 0.0)],
                                   "series string, p int, d int, q int, const double, mu double, ar array<double>, ma array<double>, sigma2 double, "
                                   "zs array<double>, es array<double>, y_last double, dy_last double")
    got = [r["yhat"] for r in T.forecast(models, 200).orderBy("h").collect()]
    want, z = [], 4.0
    for _ in range(200):
        z = 1.0 + 0.5 * z
        want.append(z)
    assert len(got) == 200 and all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
