"""Forecast intervals from simulated paths.

Every model draws ``n_paths`` futures: the same recursion as ``timeseries.forecast``
with a normal shock of the model's variance in each step.  Shocks come from hashes of
(seed, series, path, step), so reruns, retries and other engines draw the same paths.
A step's paths meet in a mergeable quantile sketch, built in each task before the
shuffle; the paths themselves are never gathered, and a single series spreads over
tasks by its paths.

A model without a variance (a fallback of a constant series) has paths without shocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..session import materialize
from .timeseries import dot, fold

PATH_TYPE = "array<struct<h:int,y:double>>"
ACCURACY = 10_000
#: Simulated steps in a task, about.
TASK_STEPS = 2_000_000


def shock(series: Column, path: Column, h: Column, seed: int) -> Column:
    """A standard normal number: Box-Muller of two hashes."""
    u = [unit_hash(F.concat_ws(":", series.cast("string"), path.cast("string"), h.cast("string"), F.lit(str(i))), seed) for i in (1, 2)]
    return F.sqrt(-2.0 * F.log(1.0 - u[0])) * F.cos(2.0 * math.pi * u[1])


def paths(models: DataFrame, horizon: int, n_paths: int, seed: int = 0, key: str = "series") -> DataFrame:
    """``(key, path, h, y)``: n_paths futures of every model row."""
    if horizon < 1 or n_paths < 1:
        raise ValueError("horizon and n_paths must be at least 1")
    models = materialize(models, "models")
    tasks = max(1, models.count() * n_paths * horizon // TASK_STEPS + 1)
    rows = models.withColumn("path", F.explode(F.sequence(F.lit(1), F.lit(n_paths)))).repartition(tasks)
    d, sigma = F.col("d"), F.sqrt(F.coalesce(F.col("sigma2"), F.lit(0.0)))
    init = F.struct(F.col("zs").cast("array<double>").alias("zs"), F.col("es").cast("array<double>").alias("es"),
                    F.col("y_last").cast("double").alias("lv"), F.col("dy_last").cast("double").alias("dv"),
                    F.array().cast(PATH_TYPE).alias("out"))

    def step(acc, h):
        e = sigma * shock(F.col(key), F.col("path"), h, seed)
        zc = F.col("const") + dot(F.col("ar"), acc["zs"]) + dot(F.col("ma"), acc["es"]) + e
        z = zc + F.col("mu")
        dv = F.when(d == 2, acc["dv"] + z).otherwise(acc["dv"])
        y = F.when(d == 0, z).when(d == 1, acc["lv"] + z).otherwise(acc["lv"] + dv)
        return F.struct(
            F.slice(F.concat(F.array(zc), acc["zs"]), 1, 8).alias("zs"), F.slice(F.concat(F.array(e), acc["es"]), 1, 8).alias("es"),
            y.alias("lv"), dv.alias("dv"), F.concat(acc["out"], F.array(F.struct(h.cast("int").alias("h"), y.alias("y")))).alias("out"))

    rows, outs = fold(rows, init, step, horizon, PATH_TYPE)
    return rows.select(key, "path", F.inline(outs)).withColumn("h", F.col("h").cast("long"))


def intervals(models: DataFrame, horizon: int, level: float = 0.95, n_paths: int = 1000, seed: int = 0, key: str = "series") -> DataFrame:
    """``(key, h, median, lo, hi, n)``: quantiles of each step's simulated values."""
    if not 0 < level < 1:
        raise ValueError("level must be between 0 and 1")
    tail = (1 - level) / 2
    sketch = F.percentile_approx("y", [0.5, tail, 1 - tail], ACCURACY)
    steps = paths(models, horizon, n_paths, seed, key).groupBy(key, "h").agg(sketch.alias("q"), F.count(F.lit(1)).alias("n"))
    return steps.select(key, "h", F.col("q")[0].alias("median"), F.col("q")[1].alias("lo"), F.col("q")[2].alias("hi"), "n")
