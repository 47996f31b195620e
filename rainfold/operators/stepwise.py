"""Stepwise search of ARMA orders, all series at once.

The search starts from a few small orders, then tries the neighbours of each
series' best order (one more or less of either) until no neighbour is better.
Tried orders are a table, so are the next ones; every round fits the next orders
of all series together and ends the search of those that have none left.  A
series takes as many rounds as its path is long, and orders off its path are
never fitted, which pays where a fit is expensive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import timeseries as T

#: The orders (p, q) that the search starts from.
START = ((1, 1), (0, 0), (1, 0), (0, 1))


def _orders(found: list[tuple[Column, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(p.cast("int").alias("p"), q.cast("int").alias("q")) for p, q in found]))


def best(tried: DataFrame) -> DataFrame:
    """``(series, p, q)``: the lowest AIC among the usable orders tried so far, ties
    to the smaller p, then q; the smallest order where none is usable."""
    score = F.when(F.col("ok"), F.col("aic")).otherwise(F.lit(float("inf")))
    return tried.groupBy("series").agg(F.min(F.struct(score.alias("score"), "p", "q")).alias("b")).select("series", "b.p", "b.q")


def search(series: DataFrame, fit: Callable[[DataFrame], DataFrame], max_p: int = T.MAX_P, max_q: int = T.MAX_Q) -> DataFrame:
    """Every order that was tried, as ``fit`` returned it (series, p, q, aic, ok, …).

    ``series`` names the series; ``fit`` takes orders ``(series, p, q)``.  At most
    (max_p + 1)(max_q + 1) rounds, whatever the number of series.
    """
    inside = F.col("p").between(0, max_p) & F.col("q").between(0, max_q)
    first = series.select("series").distinct().select("series", _orders([(F.lit(p), F.lit(q)) for p, q in START]).alias("o"))
    frontier, tried = first.select("series", "o.*").filter(inside), None
    while True:
        fits = materialize(fit(frontier), "order-fits")
        tried = fits if tried is None else tried.unionByName(fits)
        near = [(F.col("p") + i, F.col("q") + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
        asked = best(tried).select("series", _orders(near).alias("o")).select("series", "o.*").filter(inside)
        done = tried.select(F.col("series").alias("_series"), F.col("p").alias("_p"), F.col("q").alias("_q"))
        known = F.col("series").eqNullSafe(F.col("_series")) & (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q"))
        frontier = materialize(asked.join(done, known, "left_anti"), "order-frontier")
        if frontier.isEmpty():
            return tried
