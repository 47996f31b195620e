"""Time-series queries: unit-root test, differencing order, AR(1) and ARIMA
fits, forecasts with intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import css as CS
from ..operators import lagsums as S
from ..operators import relational as R
from ..operators import simulate as SIM
from ..operators import stepwise as W
from ..operators import timeseries as T
from ..session import materialize
from . import fixtures as X
from . import oracle_arima as A
from . import oracle_sql as O
from .common import finish
from .registry import register

HORIZON = 24
Z95 = 1.959963984540054


def indexed(spark, sf_dir):
    """Series positions.  The hourly series (small next to the raw events) is
    written once first, so the sampling of ranges and the numbering, which both
    read it, do not scan and aggregate the raw events twice."""
    series = materialize(X.ts_series(spark, sf_dir), "ts-series")
    return R.position_index(series, "ts", key="series", idx="idx")


def lagged(spark, sf_dir, max_lag=3):
    return T.lag_table(indexed(spark, sf_dir), "series", "idx", "y", max_lag)


def _adf_sql(d: int) -> str:
    z = {0: ("l1", "y - l1"),
         1: ("l1 - l2", "(y - l1) - (l1 - l2)"),
         2: ("l1 - 2 * l2 + l3", "(y - 2 * l1 + l2) - (l1 - 2 * l2 + l3)")}[d]
    x, dz = z
    return f"""SELECT series, {d} AS d, regr_count({dz}, {x}) AS n,
       regr_sxy({dz}, {x}) / regr_sxx({dz}, {x}) AS beta,
       (regr_sxy({dz}, {x}) / regr_sxx({dz}, {x})) /
         sqrt((regr_syy({dz}, {x}) - regr_sxy({dz}, {x}) * regr_sxy({dz}, {x}) / regr_sxx({dz}, {x}))
              / (regr_count({dz}, {x}) - 2) / regr_sxx({dz}, {x})) AS t_stat
FROM ts_lag GROUP BY series"""


def _augmented_sql(d: int) -> str:
    """Two lagged differences by partialling out: each regressor is freed of the
    ones before it (one simple regression after another), the last one's
    coefficient is then the multiple regression's."""
    def z(k):
        return {0: f"v{k}", 1: f"(v{k} - v{k + 1})", 2: f"(v{k} - 2 * v{k + 1} + v{k + 2})"}[d]
    dz = [f"({z(j)} - {z(j + 1)})" for j in range(3)]
    free = lambda y, x, o: f"{y} - (regr_slope({y}, {x}) OVER w * {x} + regr_intercept({y}, {x}) OVER w) AS {o}"
    return f"""SELECT * FROM (WITH a{d} AS (SELECT series, {z(1)} AS x, {dz[1]} AS g1, {dz[2]} AS g2, {dz[0]} AS y FROM lag5),
  b{d} AS (SELECT * FROM a{d} WHERE x IS NOT NULL AND g1 IS NOT NULL AND g2 IS NOT NULL AND y IS NOT NULL),
  c{d} AS (SELECT series, {free('x', 'g1', 'x1')}, {free('g2', 'g1', 'h')}, {free('y', 'g1', 'y1')} FROM b{d} WINDOW w AS (PARTITION BY series)),
  e{d} AS (SELECT series, {free('x1', 'h', 'x2')}, {free('y1', 'h', 'y2')} FROM c{d} WINDOW w AS (PARTITION BY series))
  SELECT series, {d} AS d, count(*) AS n, regr_slope(y2, x2) AS beta,
    regr_slope(y2, x2) / sqrt((regr_syy(y2, x2) - regr_sxy(y2, x2) * regr_sxy(y2, x2) / regr_sxx(y2, x2)) / (count(*) - 4) / regr_sxx(y2, x2)) AS t_stat
  FROM e{d} GROUP BY series)"""


_LAG5 = "lag5 AS (SELECT series, y AS v0, " + ", ".join(f"lag(y, {k}) OVER w AS v{k}" for k in range(1, 6)) + " FROM ts_idx WINDOW w AS (PARTITION BY series ORDER BY idx))"


@register("adf_augmented", f"""WITH {O.TS_SERIES}, {_LAG5},
adf AS ({' UNION ALL '.join(_augmented_sql(d) for d in range(3))})
SELECT series, d, n, round(beta, 6) AS beta, round(t_stat, 6) AS t_stat FROM adf""")
def adf_augmented(spark, sf_dir):
    """Augmented Dickey–Fuller (two lagged differences) at d = 0, 1, 2 per series."""
    return finish(T.adf_stats_augmented(lagged(spark, sf_dir, 5), 2, "series").drop("constant"))


ADF_SQL = f"""{O.TS_SERIES},
adf AS ({' UNION ALL '.join(_adf_sql(d) for d in range(3))})"""


@register("adf_stat", f"""WITH {ADF_SQL}
SELECT series, d, CAST(n AS BIGINT) AS n, round(beta, 6) AS beta, round(t_stat, 6) AS t_stat FROM adf""")
def adf_stat(spark, sf_dir):
    """Dickey–Fuller t-statistics of each series at d = 0, 1, 2."""
    out = T.adf_stats(lagged(spark, sf_dir), "series")
    return finish(out.drop("constant").withColumn("d", F.col("d").cast("int")).withColumn("n", F.col("n").cast("long")))


@register("select_d", f"""WITH {ADF_SQL}
SELECT series, CAST(coalesce(min(CASE WHEN t_stat < {T.ADF_CRITICAL_5PCT} THEN d END), 2) AS INTEGER) AS d
FROM adf GROUP BY series""")
def select_d(spark, sf_dir):
    """Differencing order per series: the first d that rejects a unit root at 5 %."""
    return T.select_d(T.adf_stats(lagged(spark, sf_dir), "series"), "series").select("series", "d")


AR1_SQL = f"""{O.TS_SERIES},
ar1 AS (
  SELECT series, regr_count(y, l1) AS n, regr_slope(y, l1) AS phi, regr_intercept(y, l1) AS c,
         (regr_syy(y, l1) - regr_sxy(y, l1) * regr_sxy(y, l1) / regr_sxx(y, l1)) / (regr_count(y, l1) - 2) AS sigma2,
         max_by(y, idx) AS y_last
  FROM ts_lag GROUP BY series
)"""


@register("ar1_fit", f"""WITH {AR1_SQL}
SELECT series, CAST(n AS BIGINT) AS n, round(phi, 6) AS phi, round(c, 6) AS c, round(sigma2, 6) AS sigma2,
       round(y_last, 6) AS y_last FROM ar1""")
def ar1_fit(spark, sf_dir):
    """y_t = c + φ·y_{t-1} per series by least squares."""
    return finish(T.ar1_fit(lagged(spark, sf_dir, 1), "series").withColumn("n", F.col("n").cast("long")))


@register("forecast_ar1", f"""WITH {AR1_SQL},
hsteps AS (SELECT series, c, phi, sigma2, y_last, CAST(h AS BIGINT) AS h FROM ar1, range(1, {HORIZON + 1}) t(h)),
fc AS (
  SELECT series, h,
         c * (1 - pow(phi, h)) / (1 - phi) + pow(phi, h) * y_last AS yhat,
         sqrt(sigma2 * (1 - pow(phi, 2 * h)) / (1 - phi * phi)) AS se
  FROM hsteps
)
SELECT series, h, round(yhat, 6) AS yhat, round(se, 6) AS se,
       round(yhat - {Z95} * se, 6) AS lo, round(yhat + {Z95} * se, 6) AS hi FROM fc""")
def forecast_ar1(spark, sf_dir):
    """AR(1) forecasts for 24 steps by the recursive fold (checked against the closed form)."""
    models = T.ar1_as_model(T.ar1_fit(lagged(spark, sf_dir, 1), "series"))
    return finish(T.forecast(models, HORIZON))


COEFS = [f"{c}{i}" for c in "ab" for i in (1, 2, 3)]


def _rounded(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def _coefs():
    return [F.try_element_at(F.col(c), F.lit(i)).alias(f"{n}{i}") for n, c in (("a", "ar"), ("b", "ma")) for i in (1, 2, 3)]


def _finite(*cols):
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & (F.abs(F.col(c)) < float("inf"))
    return out


def summed(spark, sf_dir):
    """The lag sums of every series, written once: what all the fits read."""
    return materialize(S.summary(indexed(spark, sf_dir)), "lag-sums")


def selected_models(spark, sf_dir):
    return S.models(summed(spark, sf_dir))


@register("select_d_augmented", f"WITH {A.UNIT_ROOT} SELECT o.series, o.d, CAST(a.n AS BIGINT) AS n, round(a.beta, 6) AS beta, round(a.t_stat, 6) AS t_stat FROM orders o JOIN adf a ON o.series = a.series AND a.d = 0")
def select_d_augmented(spark, sf_dir):
    """Differencing order per series by the augmented test with each series' own
    number of lagged differences, and the test of the series as it is."""
    tests = materialize(S.unit_root_tests(summed(spark, sf_dir)), "tests")
    first = tests.filter("d = 0").select(F.col("series").alias("_s"), "n", "beta", "t_stat")
    return finish(T.select_d(tests).join(first, F.col("series").eqNullSafe(F.col("_s"))).select("series", "d", "n", "beta", "t_stat"))


_GRID = ["const", *COEFS, "sigma2", "aic"]


@register("arima_grid", f"WITH {A.FITS} SELECT series, p, q, n, {_rounded(_GRID)}, ok FROM grid")
def arima_grid(spark, sf_dir):
    """All 16 (p, q) candidates of every series: coefficients, variance, AIC, and
    whether they are stationary and invertible."""
    return finish(S.grid(summed(spark, sf_dir)).select("series", "p", "q", "n", "const", *_coefs(), "sigma2", "aic", "ok"))


@register("arima_fit", f"WITH {A.FITS} SELECT series, p, q, {_rounded(['const', 'a1', 'b1', 'sigma2'])} FROM grid WHERE p = 1 AND q = 1")
def arima_fit(spark, sf_dir):
    """ARMA(1, 1) on the differenced series, per series (Hannan–Rissanen, by the
    lag table's own two stages)."""
    fits = T.fit_grid(T.prepare(indexed(spark, sf_dir))).filter("p = 1 AND q = 1")
    return finish(fits.select("series", "p", "q", "const", F.col("ar")[0].alias("a1"), F.col("ma")[0].alias("b1"), "sigma2"))


_BEST = ["const", *COEFS, "mu", "sigma2", "aic", "y_last", "dy_last"]


@register("arima_select", f"WITH {A.FITS} SELECT series, p, d, q, n, {_rounded(_BEST)}, 'fitted' AS status FROM best")
def arima_select(spark, sf_dir):
    """Best order of every series by AIC, with d from the unit-root test."""
    return finish(selected_models(spark, sf_dir).select("series", "p", "d", "q", "n", "const", *_coefs(), "mu", "sigma2", "aic", "y_last", "dy_last", "status"))


@register("arima_stepwise", f"WITH RECURSIVE {A.STEPWISE} SELECT s.series, s.p, s.q, round(g.aic, 6) AS aic, g.ok FROM stop s JOIN grid g ON s.series = g.series AND s.p = g.p AND s.q = g.q")
def arima_stepwise(spark, sf_dir):
    """The order that a stepwise search from four small orders ends at, per series."""
    state = summed(spark, sf_dir)
    tried = W.search(state, lambda orders: S.fit_orders(state, orders))
    at = W.best(tried).withColumnsRenamed({"series": "_s", "p": "_p", "q": "_q"})
    same = F.col("series").eqNullSafe(F.col("_s")) & (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q"))
    return finish(tried.join(at, same).select("series", "p", "q", "aic", "ok"))


_CSS_ORDERS = [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1)]
_CSS = ["const", "a1", "a2", "sigma2", "aic"]


@register("arima_css", f"""WITH {A.FITS}, {A.CSS_ROWS}
SELECT series, p, q, n, {_rounded(_CSS)}, true AS no_worse FROM css
UNION ALL SELECT series, p, q, NULL, NULL, NULL, NULL, NULL, NULL, true FROM (SELECT DISTINCT series FROM ts_idx), (VALUES (0, 1), (1, 1)) o(p, q)""")
def arima_css(spark, sf_dir):
    """Conditional least squares for five orders of every series, from the grid's
    fits; without a moving average they are those of ordinary least squares."""
    idx = materialize(indexed(spark, sf_dir), "positions")
    wanted = F.concat_ws(",", "p", "q").isin([f"{p},{q}" for p, q in _CSS_ORDERS])
    start = materialize(S.grid(S.summary(idx)).filter(wanted), "css-start")
    fits = CS.fit(CS.cut(idx), start)
    plain = lambda c: F.when(F.col("q") == 0, c)
    return finish(fits.select("series", "p", "q", plain(F.col("n")).alias("n"), *[plain(c).alias(n) for n, c in (
        ("const", F.col("const")), ("a1", F.try_element_at("ar", F.lit(1))), ("a2", F.try_element_at("ar", F.lit(2))), ("sigma2", F.col("sigma2")), ("aic", F.col("aic")))],
        (F.col("aic") <= F.col("start_aic")).alias("no_worse")))


@register("arima_grow", f"WITH {A.FITS} SELECT series, p, d, q, n, {_rounded(_BEST)}, 'fitted' AS status FROM best")
def arima_grow(spark, sf_dir):
    """Models of stored lag sums that later hours were added to, three batches a
    series; old hours are read for their own batch only."""
    from ..session import scratch_path
    from ..sources import models as MS

    idx, path = materialize(indexed(spark, sf_dir), "positions"), scratch_path(spark, "lag-sums")
    batch = F.least(F.lit(2), F.expr("idx div 300"))
    for n in range(3):
        MS.grow_states(spark, path, n, idx.filter(batch == n))
    return finish(S.models(MS.load_states(spark, path)).select("series", "p", "d", "q", "n", "const", *_coefs(), "mu", "sigma2", "aic", "y_last", "dy_last", "status"))


@register("forecast_n", f"WITH RECURSIVE {A.forecasts(HORIZON)} SELECT series, h, round(yhat, 6) AS yhat FROM fc")
def forecast_n(spark, sf_dir):
    """Point forecasts 24 steps ahead from each series' selected ARIMA model."""
    return finish(T.forecast(selected_models(spark, sf_dir), HORIZON).select("series", "h", "yhat"))


_FC_SQL = f"""WITH RECURSIVE {A.forecasts(HORIZON)}
SELECT series, h, round(yhat, 6) AS yhat, round(se, 6) AS se, round(yhat - {Z95} * se, 6) AS lo, round(yhat + {Z95} * se, 6) AS hi FROM fc"""


@register("forecast_interval", _FC_SQL)
def forecast_interval(spark, sf_dir):
    """Forecasts with 95 % intervals (ψ-weights, integrated for d ≥ 1)."""
    return finish(T.forecast(selected_models(spark, sf_dir), HORIZON, 0.95))


SIM_PATHS, SIM_SEED = 200, 7


@register("forecast_simulated", f"""WITH RECURSIVE {A.simulated(HORIZON, SIM_PATHS, SIM_SEED)}
SELECT series, h, round(quantile_disc(lv, 0.5), 6) AS median, round(quantile_disc(lv, 0.05), 6) AS lo, round(quantile_disc(lv, 0.95), 6) AS hi, count(*) AS n
FROM ahead WHERE h > 0 GROUP BY series, h""")
def forecast_simulated(spark, sf_dir):
    """90 % intervals from simulated paths of each series' selected model."""
    return finish(SIM.intervals(selected_models(spark, sf_dir), HORIZON, 0.9, SIM_PATHS, SIM_SEED))


@register("arima_model_roundtrip", f"WITH RECURSIVE {A.forecasts(HORIZON)} SELECT series, h, round(yhat, 6) AS yhat, true AS same FROM fc")
def arima_model_roundtrip(spark, sf_dir):
    """Store the selected models, load them back and forecast 24 steps from the
    stored copy (as the reference's service loads its saved models per call)."""
    from ..session import scratch_path
    from ..sources import models as MS

    path = scratch_path(spark, "arima-models")
    models = materialize(selected_models(spark, sf_dir), "models")
    MS.save_forecast_models(models, path)
    stored = T.forecast(MS.load_forecast_models(spark, path), HORIZON).select("series", "h", "yhat", F.struct("yhat", "lo", "hi").alias("stored"))
    fresh = T.forecast(models, HORIZON).select("series", "h", F.struct("yhat", "lo", "hi").alias("fresh"))
    return finish(stored.join(fresh, ["series", "h"], "left").select("series", "h", "yhat", F.col("fresh").eqNullSafe(F.col("stored")).alias("same")))
