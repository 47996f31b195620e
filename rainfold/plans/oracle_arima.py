"""DuckDB text of the ARIMA fits, used to build oracle queries.

Least squares with many regressors is written as a chain of common table
expressions: columns are centred, then each regressor in turn is taken out of all
that follow it (a modified Gram–Schmidt), and the coefficients are put together
backwards at the end.  Unit-root tests, the long autoregression, every order's fit,
the choice of the order and the forecasts follow from that by value.
"""

from __future__ import annotations

from ..functions.hashing import unit_hash_sql
from ..operators import timeseries as T
from . import oracle_sql as O

M, P, Q, D = T.LONG_AR, T.MAX_P, T.MAX_Q, T.MAX_D


def _chain(name: str, source: str, xs: list[str], y: str, keep: str = "") -> list[str]:
    """CTEs ``name_0 … name_k``: the last has, for every row, the residual ``y``,
    the part ``u<j>`` of each regressor that is free of those before it, their
    means ``m<j>``, ``my``, and the slopes ``r<i>_<j>`` and ``c<i>``."""
    k, w, more = len(xs), "(PARTITION BY series)", f", {keep}" if keep else ""
    cols = ", ".join(f"{x} - avg({x}) OVER {w} AS u{j}, avg({x}) OVER {w} AS m{j}" for j, x in enumerate(xs))
    out = [f"{name}_0 AS (SELECT series{more}, {y} - avg({y}) OVER {w} AS y, avg({y}) OVER {w} AS my{', ' + cols if cols else ''} FROM {source})"]
    for i in range(k):
        slope = lambda c: f"coalesce(sum({c} * u{i}) OVER {w} / nullif(sum(u{i} * u{i}) OVER {w}, 0), 0)"  # noqa: E731, B023
        free = ", ".join(f"u{j} - {slope(f'u{j}')} * u{i} AS u{j}" for j in range(i + 1, k))
        known = ", ".join([f"{slope('y')} AS c{i}", *[f"{slope(f'u{j}')} AS r{i}_{j}" for j in range(i + 1, k)]])
        out.append(f"{name}_{i + 1} AS (SELECT * REPLACE (y - {slope('y')} * u{i} AS y{', ' + free if free else ''}), {known} FROM {name}_{i})")
    return out


def _fit(name: str, source: str, xs: list[str], y: str) -> list[str]:
    """``name(series, n, rss, b0 …, const)``: the whole fit, a row a series."""
    k = len(xs)
    last = f"{name}_{k}"
    firsts = [f"any_value({c}) AS {c}" for c in ["my", *[f"m{j}" for j in range(k)], *[f"c{i}" for i in range(k)], *[f"r{i}_{j}" for i in range(k) for j in range(i + 1, k)]]]
    out = _chain(name, source, xs, y)
    out.append(f"{name}_s AS (SELECT series, count(*) AS n, sum(y * y) AS rss, {', '.join(firsts)} FROM {last} GROUP BY series)")
    at = f"{name}_s"
    for i in reversed(range(k)):
        back = "".join(f" - r{i}_{j} * b{j}" for j in range(i + 1, k))
        out.append(f"{name}_b{i} AS (SELECT *, c{i}{back} AS b{i} FROM {at})")
        at = f"{name}_b{i}"
    minus = "".join(f" - b{j} * m{j}" for j in range(k))
    out.append(f"{name} AS (SELECT *, my{minus} AS const FROM {at})")
    return out


def _z(d: int, k: int, v: str = "v") -> str:
    return {0: f"{v}{k}", 1: f"({v}{k} - {v}{k + 1})", 2: f"({v}{k} - 2 * {v}{k + 1} + {v}{k + 2})"}[d]


def _adf() -> list[str]:
    """``adf(series, d, n, beta, t_stat)`` with each series' own number of lagged differences."""
    most = T.MAX_ADF_LAGS
    lags = ", ".join(f"lag(y, {k}) OVER w AS v{k}" for k in range(1, D + most + 2))
    out = [f"lagged AS MATERIALIZED (SELECT series, idx, y AS v0, {lags}, CAST(least(floor(pow(count(*) OVER (PARTITION BY series) - 1, 1.0 / 3) + 1e-9), {most}) AS INTEGER) AS k "
           "FROM ts_idx WINDOW w AS (PARTITION BY series ORDER BY idx))"]
    for d in range(D + 1):
        dz = [f"({_z(d, j)} - {_z(d, j + 1)})" for j in range(most + 1)]
        gs = ", ".join(f"CASE WHEN {j} <= k THEN {dz[j]} ELSE 0 END AS g{j}" for j in range(1, most + 1))
        out.append(f"adf_rows{d} AS (SELECT series, k, {dz[0]} AS dz, {_z(d, 1)} AS x, {gs} FROM lagged WHERE idx > k + {d + 1})")
        out += _chain(f"adf{d}", f"adf_rows{d}", [*[f"g{j}" for j in range(1, most + 1)], "x"], "dz", "k")
        out.append(f"""adf_{d}_out AS (SELECT series, {d} AS d, count(*) AS n, any_value(c{most}) AS beta,
  any_value(c{most}) / sqrt(sum(y * y) / (count(*) - 2 - any_value(k)) / sum(u{most} * u{most})) AS t_stat FROM adf{d}_{most + 1} GROUP BY series)""")
    out.append("adf AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM adf_{d}_out" for d in range(D + 1)) + ")")
    out.append(f"orders AS MATERIALIZED (SELECT series, CAST(coalesce(min(CASE WHEN t_stat < {T.ADF_CRITICAL_5PCT} THEN d END), {D}) AS INTEGER) AS d FROM adf GROUP BY series)")
    return out


def _inside(cs: list[str]) -> str:
    """Whether 1 - c1 x - … has its roots outside the unit circle: all partial
    coefficients of the step-down recursion below 1."""
    if not cs:
        return "true"
    r = cs[-1]
    rest = [f"(({c}) + ({r}) * ({cs[-2 - i]})) / (1 - ({r}) * ({r}))" for i, c in enumerate(cs[:-1])]
    return f"(CASE WHEN abs({r}) < 1 THEN {_inside(rest)} ELSE false END)"


def _candidates() -> list[str]:
    """``grid(series, p, q, n, const, a1 …, b1 …, sigma2, aic, ok)`` and ``state``."""
    zs = ", ".join(f"lag(z, {k}) OVER w AS z{k}" for k in range(1, M + 1))
    out = [f"""diffs AS (SELECT l.series, l.idx, l.v0, l.v1, o.d, CASE o.d WHEN 0 THEN {_z(0, 0)} WHEN 1 THEN {_z(1, 0)} ELSE {_z(2, 0)} END AS z FROM lagged l JOIN orders o USING (series))""",
           "centred AS MATERIALIZED (SELECT * REPLACE (z - avg(z) OVER (PARTITION BY series) AS z), avg(z) OVER (PARTITION BY series) AS mu FROM diffs)",
           f"long_rows AS (SELECT series, idx, z AS z0, {zs} FROM centred WINDOW w AS (PARTITION BY series ORDER BY idx) QUALIFY z{M} IS NOT NULL)"]
    out += _chain("long", "long_rows", [f"z{k}" for k in range(1, M + 1)], "z0", "idx")
    e = ", ".join(f"lag(r.y, {k}) OVER w AS e{k}" for k in range(1, Q + 1))
    z = ", ".join(f"lag(c.z, {k}) OVER w AS z{k}" for k in range(1, P + 1))
    out.append(f"""stage2 AS MATERIALIZED (SELECT c.series, c.idx, c.z AS z0, r.y AS e0, {z}, {e} FROM centred c LEFT JOIN long_{M} r ON c.series = r.series AND c.idx = r.idx
  WINDOW w AS (PARTITION BY c.series ORDER BY c.idx))""")
    out.append(f"full_rows AS MATERIALIZED (SELECT * FROM stage2 WHERE e{Q} IS NOT NULL AND z{P} IS NOT NULL)")
    parts = []
    for p in range(P + 1):
        for q in range(Q + 1):
            name = f"f{p}{q}"
            out += _fit(name, "full_rows", [*[f"z{i}" for i in range(1, p + 1)], *[f"e{j}" for j in range(1, q + 1)]], "z0")
            a = [f"b{i}" if i < p else "NULL" for i in range(P)]
            b = [f"b{p + j}" if j < q else "NULL" for j in range(Q)]
            ok = f"{_inside(a[:p])} AND {_inside([f'-{x}' for x in b[:q]])}"
            coefs = ", ".join([f"{x} AS a{i + 1}" for i, x in enumerate(a)] + [f"{x} AS b{j + 1}" for j, x in enumerate(b)])
            parts.append(f"SELECT series, {p} AS p, {q} AS q, n, const, {coefs}, rss / n AS sigma2, n * ln(rss / n) + {2 * (p + q + 2)} AS aic, {ok} AS ok FROM {name}")
    out.append(f"grid AS MATERIALIZED ({' UNION ALL '.join(parts)})")
    last = ", ".join(f"coalesce(nth_value({v}, {k + 1}) OVER w, 0) AS {n}{k + 1}" for n, v in (("s", "z0"), ("t", "e0")) for k in range(3))
    out.append(f"""state AS (SELECT * FROM (SELECT series, idx, {last} FROM stage2 WINDOW w AS (PARTITION BY series ORDER BY idx DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY idx DESC) = 1)""")
    out.append("ends AS (SELECT series, d, mu, v0 AS y_last, v0 - v1 AS dy_last FROM centred QUALIFY row_number() OVER (PARTITION BY series ORDER BY idx DESC) = 1)")
    out.append("best AS MATERIALIZED (SELECT g.*, s.* EXCLUDE (series, idx), e.* EXCLUDE (series) FROM grid g JOIN state s USING (series) JOIN ends e USING (series) "
               "WHERE ok QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic, p, q) = 1)")
    return out


def fits(source: str) -> str:
    """Everything down to ``best`` for ``ts_idx(series, idx, y)``, which ``source`` defines."""
    return ",\n".join([source, *_adf(), *_candidates()])


UNIT_ROOT = ",\n".join([O.TS_SERIES, *_adf()])
FITS = fits(O.TS_SERIES)


def _forecasts(models: str, horizon: int, shock: str = "0") -> str:
    """``fc(series, h, yhat, se)`` by stepping the equation of ``models``; ``shock``
    is a step's residual."""
    c = lambda x: f"coalesce({x}, 0)"
    zc = "const + " + " + ".join(f"{c(f'a{i}')} * s{i}" for i in (1, 2, 3)) + " + " + " + ".join(f"{c(f'b{i}')} * t{i}" for i in (1, 2, 3)) + f" + {shock}"
    psi = "CASE WHEN h = 0 THEN 1 ELSE coalesce(CASE h WHEN 1 THEN b1 WHEN 2 THEN b2 WHEN 3 THEN b3 END, 0) + " + " + ".join(f"{c(f'a{i}')} * p{i}" for i in (1, 2, 3)) + " END"
    return f"""ahead AS (
  SELECT m.*, CAST(0 AS BIGINT) AS h, CAST(0 AS DOUBLE) AS p1, CAST(0 AS DOUBLE) AS p2, CAST(0 AS DOUBLE) AS p3, CAST(0 AS DOUBLE) AS c1, CAST(0 AS DOUBLE) AS c2,
         CAST(0 AS DOUBLE) AS ss, y_last AS lv, dy_last AS dv FROM {models} m
  UNION ALL
  SELECT * REPLACE (h + 1 AS h, {zc} AS s1, s1 AS s2, s2 AS s3, {shock} AS t1, t1 AS t2, t2 AS t3, {psi} AS p1, p1 AS p2, p2 AS p3,
    c1 + {psi} AS c1, c2 + c1 + {psi} AS c2,
    ss + pow(CASE d WHEN 0 THEN {psi} WHEN 1 THEN c1 + {psi} ELSE c2 + c1 + {psi} END, 2) AS ss,
    CASE d WHEN 0 THEN {zc} + mu WHEN 1 THEN lv + {zc} + mu ELSE lv + dv + {zc} + mu END AS lv, CASE d WHEN 2 THEN dv + {zc} + mu ELSE dv END AS dv)
  FROM ahead WHERE h < {horizon}
),
fc AS (SELECT series, h, lv AS yhat, sqrt(sigma2 * ss) AS se FROM ahead WHERE h > 0)"""


def forecasts(horizon: int, models: str = "best", source: str = O.TS_SERIES) -> str:
    """Everything down to ``fc``, after WITH RECURSIVE."""
    return f"{fits(source)},\n{_forecasts(models, horizon)}"


def simulated(horizon: int, n_paths: int, seed: int) -> str:
    """Paths of the chosen models with hashed normal shocks, ``ahead(series, path, h, lv)``."""
    u = [unit_hash_sql(f"series || ':' || path || ':' || (h + 1) || ':{i}'", seed) for i in (1, 2)]
    shock = f"sqrt(coalesce(sigma2, 0)) * sqrt(-2 * ln(1 - {u[0]})) * cos(2 * pi() * {u[1]})"
    return f"""{FITS},
every AS (SELECT b.*, CAST(r.i AS BIGINT) AS path FROM best b, range(1, {n_paths + 1}) r(i)),
{_forecasts("every", horizon, shock)}"""


#: From each order the best of itself and its neighbours, followed until none moves.
STEPWISE = f"""{FITS},
usable AS (SELECT series, p, q, CASE WHEN ok THEN aic ELSE 'Infinity'::DOUBLE END AS score FROM grid),
moves AS MATERIALIZED (
  SELECT a.series, a.p, a.q, b.p AS np, b.q AS nq FROM usable a JOIN usable b ON a.series = b.series AND abs(a.p - b.p) <= 1 AND abs(a.q - b.q) <= 1
  QUALIFY row_number() OVER (PARTITION BY a.series, a.p, a.q ORDER BY b.score, b.p, b.q) = 1
),
walk AS (
  SELECT * FROM (SELECT series, p, q, 0 AS step FROM usable WHERE p <= 1 AND q <= 1 QUALIFY row_number() OVER (PARTITION BY series ORDER BY score, p, q) = 1)
  UNION ALL SELECT w.series, m.np, m.nq, w.step + 1 FROM walk w JOIN moves m ON w.series = m.series AND w.p = m.p AND w.q = m.q WHERE m.np <> w.p OR m.nq <> w.q
),
stop AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY series ORDER BY step DESC) = 1)"""


#: Autoregressions by least squares on the positions that the conditional fits use.
CSS_ROWS = ",\n".join([f"css_rows AS MATERIALIZED (SELECT * FROM stage2 WHERE z{P} IS NOT NULL)", *[
    c for p in range(3) for c in _fit(f"css{p}", "css_rows", [f"z{i}" for i in range(1, p + 1)], "z0")], "css AS (" + " UNION ALL ".join(
    f"SELECT series, {p} AS p, 0 AS q, n, const, {'b0' if p else 'NULL'} AS a1, {'b1' if p > 1 else 'NULL'} AS a2, rss / n AS sigma2, n * ln(rss / n) + {2 * (p + 2)} AS aic FROM css{p}"
    for p in range(3)) + ")"])
