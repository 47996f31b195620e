"""Simulated intervals against the formula's and against futures drawn apart."""

import numpy as np
import pytest

from rainfold.operators import simulate as S
from rainfold.operators import timeseries as T

MODEL = ("series string, p int, d int, q int, const double, mu double, ar array<double>, ma array<double>, sigma2 double, "
         "zs array<double>, es array<double>, y_last double, dy_last double")


def model(name, d, sigma2=2.0):
    return (name, 2, d, 2, 0.3, 1.5, [0.5, -0.2], [0.4, 0.1], sigma2, [0.7, -0.1, 0.2], [0.3, -0.5, 0.0], 10.0, 0.8)


def test_quantiles_come_near_the_formula(spark):
    models = spark.createDataFrame([model(f"d{d}", d) for d in range(3)], MODEL)
    want = {(r["series"], r["h"]): r for r in T.forecast(models, 6, 0.9).collect()}
    got = S.intervals(models, 6, 0.9, 2500, seed=3).collect()
    assert len(got) == 18
    for r in got:
        w = want[r["series"], r["h"]]
        assert r["n"] == 2500
        for have, exact in ((r["median"], w["yhat"]), (r["lo"], w["lo"]), (r["hi"], w["hi"])):
            assert abs(have - exact) < 0.15 * w["se"], (r, w)


def test_coverage_is_the_level(spark):
    rng = np.random.default_rng(5)
    n, horizon = 800, 4
    starts = rng.normal(0, 2, n)
    rows = [(f"s{i}", 1, 0, 0, 0.0, 5.0, [0.7], [], 1.0, [float(z)], [], float(z) + 5, 0.0) for i, z in enumerate(starts)]
    got = {(r["series"], r["h"]): (r["lo"], r["hi"]) for r in S.intervals(spark.createDataFrame(rows, MODEL), horizon, 0.9, 200, seed=9).collect()}
    inside = []
    for i, z in enumerate(starts):
        for h in range(1, horizon + 1):
            z = 0.7 * z + rng.normal()
            lo, hi = got[f"s{i}", h]
            inside.append(lo <= z + 5 <= hi)
    assert abs(np.mean(inside) - 0.9) < 0.02


def test_reruns_agree_at_any_partitioning(spark):
    models = spark.createDataFrame([model("a", 1), model("b", 0)], MODEL)
    one, two = (sorted(map(tuple, S.intervals(m, 3, 0.8, 50, seed=1).collect())) for m in (models, models.repartition(5)))
    assert one == two
    assert one != sorted(map(tuple, S.intervals(models, 3, 0.8, 50, seed=2).collect()))


def test_long_horizons_no_variance_and_bad_arguments(spark):
    models = spark.createDataFrame([model("a", 0, None), model(None, 1)], MODEL)
    flat = {r["h"]: r for r in T.forecast(models.filter("series = 'a'"), 100).collect()}
    rows = S.paths(models, 100, 3).collect()
    assert len(rows) == 600 and {r["path"] for r in rows} == {1, 2, 3}
    assert all(abs(r["y"] - flat[r["h"]]["yhat"]) < 1e-9 for r in rows if r["series"] == "a")
    assert S.intervals(models.limit(0), 3, 0.9, 5).count() == 0
    for bad in ((0, 0.9, 5), (3, 1.0, 5), (3, 0.9, 0)):
        with pytest.raises(ValueError):
            S.intervals(models, *bad)
