"""Lag sums against the lag table's fits, growth against refits, and the searches
and conditional fits that start from them against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainfold.operators import css as C
from rainfold.operators import lagsums as S
from rainfold.operators import stepwise as W
from rainfold.operators import timeseries as T
from rainfold.session import materialize, scratch_path
from rainfold.sources import batches as B
from rainfold.sources import models as MS


def arma(n, ar=(), ma=(), mean=0.0, seed=0):
    rng = np.random.default_rng(seed)
    e, z = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(3, n + 50):
        z[t] = e[t] + sum(c * z[t - i - 1] for i, c in enumerate(ar)) + sum(c * e[t - i - 1] for i, c in enumerate(ma))
    return z[50:] + mean


def made():
    walk = np.cumsum(arma(500, (0.4,), seed=3) + 0.2) + 1000
    return {"ar": arma(700, (0.6,), mean=50, seed=1), "ma": arma(600, (), (0.5, 0.3), seed=2), "walk": walk, "twice": np.cumsum(walk - 1000), "mixed": arma(900, (0.5,), (0.4,), seed=4),
            "flat": np.full(80, 7.25), "line": np.arange(60) * 0.5, "one": np.array([3.0]), "two": np.array([3.0, 5.0]), "short": arma(9, seed=5), "few": arma(20, seed=6), None: arma(300, (0.3,), seed=7)}


def rows_of(spark, series):
    return materialize(spark.createDataFrame([(k, i + 1, float(v)) for k, y in series.items() for i, v in enumerate(y)], "series string, idx long, y double"), "t-series")


@pytest.fixture(scope="module")
def series(spark):
    return rows_of(spark, made())


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict(recursive=True) for r in df.collect()}


def close(a, b, tol=1e-8):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= tol * max(1.0, abs(b)) or (np.isnan(a) and np.isnan(b))
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(close(x, y, tol) for x, y in zip(a, b))
    return a == b


@pytest.mark.parametrize("block_rows", [S.BLOCK_ROWS, 40])
def test_fits_are_those_of_the_lag_table(spark, series, block_rows):
    state = materialize(S.summary(series, block_rows), "t-state")
    tests, plain = by_key(S.unit_root_tests(state), "series", "d"), by_key(T.adf_stats_augmented(T.lag_table(series, max_lag=T.MAX_D + T.MAX_ADF_LAGS + 1)), "series", "d")
    for k, want in plain.items():
        got = tests[k]
        assert got["n"] == want["n"] and got["constant"] == want["constant"], k
        if k[0] not in ("flat", "line", "few", "short") and want["t_stat"] is not None:
            assert close(got["t_stat"], want["t_stat"], 1e-6), k
    orders = by_key(T.select_d(S.unit_root_tests(state)), "series")
    assert orders == by_key(T.select_d(T.adf_stats_augmented(T.lag_table(series, max_lag=T.MAX_D + T.MAX_ADF_LAGS + 1))), "series")
    prep = T.prepare(series)
    got, want = by_key(S.grid(state), "series", "p", "q"), by_key(T.fit_grid(prep), "series", "p", "q")
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        assert g["d"] == orders[k[:1]]["d"] and g["d_status"] == orders[k[:1]]["d_status"]
        assert g["n"] == w["n"] and close(g["var"], w["var"]), k
        if k[0] not in ("flat", "line", "few", "short", "one", "two"):  # singular systems may differ in what is left of rounding
            assert g["ok"] == w["ok"] and all(close(g[c], w[c], 1e-7) for c in ("const", "ar", "ma", "sigma2", "aic")), (k, g, w)
    best, chosen = by_key(T.arima_models(prep, T.select_order(T.fit_grid(prep))), "series"), by_key(S.models(state), "series")
    for k, w in best.items():
        g = chosen[k]
        assert (g["p"], g["d"], g["q"], g["status"]) == (w["p"], w["d"], w["q"], w["status"]), k
        assert all(close(g[c], w[c], 1e-7) for c in ("mu", "sigma2", "zs", "es", "y_last", "dy_last")), (k, g, w)


def test_growing_equals_a_refit_and_reads_new_rows_only(spark, series):
    path = scratch_path(spark, "t-grow")
    cuts = [0, 7, 12, 400, 10**6]
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        at = scratch_path(spark, "t-part")
        series.filter(F.col("idx").between(a + 1, b)).write.parquet(at)
        parts.append(spark.read.parquet(at))
    for n, part in enumerate(parts):
        state = S.extend(MS.load_states(spark, path), part) if n else S.summary(part)
        assert not {f for old in parts[:n] for f in old.inputFiles()} & set(state.inputFiles())
        assert MS.grow_states(spark, path, n, part) and not MS.grow_states(spark, path, n, part)
    with pytest.raises(ValueError):
        MS.grow_states(spark, path, 9, parts[0])
    grown, whole = by_key(MS.load_states(spark, path), "series"), by_key(S.summary(series), "series")
    assert grown.keys() == whole.keys()
    for k, w in whole.items():
        assert all(close(grown[k][c], w[c], 1e-9) for c in ("n", "last", "base", "head", "tail", "low", "high", "total", "sums")), k
    got, want = by_key(S.grid(MS.load_states(spark, path)), "series", "p", "q"), by_key(S.grid(S.summary(series)), "series", "p", "q")
    for k in ("ar", "ma", "walk", "twice", "mixed", None):
        for p in range(4):
            assert close(got[k, p, 1]["aic"], want[k, p, 1]["aic"], 1e-9)


def test_a_missing_value_raises(spark):
    bad = spark.createDataFrame([("s", 1, 1.0), ("s", 2, None)], "series string, idx long, y double")
    with pytest.raises(Exception, match="missing value"):
        S.summary(bad).collect()


def test_stepwise_is_the_plain_loop_over_the_same_scores(spark, series):
    state = materialize(S.summary(series), "t-state")
    scores = {k: (r["aic"] if r["ok"] else float("inf")) for k, r in by_key(S.grid(state), "series", "p", "q").items()}
    asked = []

    def fit(orders):
        asked.append({tuple(r) for r in orders.collect()})
        return S.fit_orders(state, orders)

    tried = W.search(state, fit)
    ends = {r["series"]: (r["p"], r["q"]) for r in W.best(tried).collect()}
    all_asked = [x for part in asked for x in part]
    assert len(all_asked) == len(set(all_asked)) == tried.count()  # nothing is fitted twice
    for s in made():
        seen = set(W.START)
        while True:
            best = min(seen, key=lambda o: (scores[s, *o], o))  # noqa: B023
            near = {(best[0] + i, best[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} - seen
            near = {o for o in near if 0 <= o[0] <= 3 and 0 <= o[1] <= 3}
            if not near:
                break
            seen |= near
        assert ends[s] == best and {x[1:] for x in all_asked if x[0] == s} == seen
    assert len(tried.filter("series = 'ar'").collect()) < 16


def residuals(z, p, q, const, ar, ma):
    e = np.zeros(len(z))
    for t in range(T.MAX_P, len(z)):
        e[t] = z[t] - const - sum(ar[i] * z[t - 1 - i] for i in range(p)) - sum(ma[j] * e[t - 1 - j] for j in range(q))
    return e[T.MAX_P:]


def test_conditional_fits_by_plain_recursion_at_any_block_size(spark):
    data = {k: v for k, v in made().items() if k in ("ar", "ma", "walk", "mixed")}
    series = rows_of(spark, data)
    start = materialize(S.grid(S.summary(series)).filter("(p, q) IN ((0, 1), (1, 0), (1, 1), (2, 1), (0, 2))"), "t-start")
    whole = by_key(C.fit(C.cut(series), start), "series", "p", "q")
    orders = by_key(start, "series", "p", "q")
    for (s, p, q), r in whole.items():
        z = np.diff(data[s], orders[s, p, q]["d"]) - orders[s, p, q]["mu"]
        e = residuals(z, p, q, r["const"], r["ar"], r["ma"])
        aic = lambda x: len(x) * np.log((x @ x) / len(x)) + 2 * (p + q + 2)  # noqa: B023, E731
        assert r["n"] == len(e) and close(r["sigma2"], e @ e / len(e), 1e-9) and close(r["aic"], aic(e), 1e-9)
        o = orders[s, p, q]
        if o["ok"]:
            assert close(r["start_aic"], aic(residuals(z, p, q, o["const"], o["ar"], o["ma"])), 1e-9)
            assert r["aic"] <= r["start_aic"]
        # no small step in any parameter is better
        theta = np.array([r["const"], *r["ar"], *r["ma"]])
        for i in range(len(theta)):
            for h in (-1e-3, 1e-3):
                t = theta.copy()
                t[i] += h
                x = residuals(z, p, q, t[0], t[1:1 + p], t[1 + p:])
                assert x @ x >= e @ e * (1 - 1e-9), (s, p, q, i)
    cut = by_key(C.fit(C.cut(series, 130), start), "series", "p", "q")
    for k, r in whole.items():
        assert all(close(cut[k][c], r[c], 1e-6) for c in ("const", "ar", "ma")) and close(cut[k]["aic"], r["aic"], 1e-10), k


def test_css_recovers_coefficients_and_searches_stepwise(spark):
    data = {"arma": arma(6000, (0.5,), (0.4,), seed=11), "ma": arma(5000, (), (0.6,), seed=12)}
    series = rows_of(spark, data)
    state, cut = materialize(S.summary(series), "t-state"), C.cut(series)
    tried = W.search(state, lambda orders: C.fit(cut, S.fit_orders(state, orders)))
    best = by_key(tried, "series", "p", "q")
    assert abs(best["arma", 1, 1]["ar"][0] - 0.5) < 0.05 and abs(best["arma", 1, 1]["ma"][0] - 0.4) < 0.05 and abs(best["ma", 0, 1]["ma"][0] - 0.6) < 0.04
    ends = {r["series"]: (r["p"], r["q"]) for r in W.best(tried).collect()}
    assert best["ma", *ends["ma"]]["aic"] <= best["ma", 0, 1]["aic"] and sum(ends["arma"]) >= 2


def test_batches_can_be_run_again(spark):
    path = scratch_path(spark, "t-batches")
    one = spark.range(5).withColumn("v", F.lit("a"))
    assert B.committed(spark, path) == []
    with pytest.raises(ValueError):
        B.read(spark, path)
    assert B.append(one, path, "2024-01-01") and not B.append(one, path, "2024-01-01")
    broken = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        B.append(broken, path, "2024-01-02")
    assert B.committed(spark, path) == ["2024-01-01"] and B.read(spark, path).count() == 5
    before = B.read(spark, path)
    assert B.append(spark.range(100).withColumn("v", F.lit("b")), path, "2024-01-02")
    assert before.count() == 5
    got = {(r["batch"], r["v"]): r["n"] for r in B.read(spark, path).groupBy("batch", "v").agg(F.count("*").alias("n")).collect()}
    assert {str(k[0]): n for k, n in got.items()} == {"2024-01-01": 5, "2024-01-02": 100}
    with pytest.raises(ValueError):
        B.append(one, path, "../x")


def test_of_two_writers_of_a_batch_one_counts(spark, monkeypatch):
    path = scratch_path(spark, "t-race")
    real = B._fs
    raced = []

    def late(sp, p):
        fs, target = real(sp, p)
        if p.endswith("batch=x") and not raced:
            raced.append(1)
            answer = real(sp, p)
            monkeypatch.setattr(B, "_fs", real)
            # the other writer commits after this one has looked
            class Fs:
                def exists(self, q):
                    if len(raced) == 1:
                        raced.append(2)
                        assert not fs.exists(q)
                        assert B.append(spark.range(3), path, "x")
                        return False
                    return fs.exists(q)

                def __getattr__(self, name):
                    return getattr(fs, name)
            return Fs(), answer[1]
        return fs, target

    monkeypatch.setattr(B, "_fs", late)
    assert not B.append(spark.range(50), path, "x")
    assert B.committed(spark, path) == ["x"] and B.read(spark, path).count() == 3
