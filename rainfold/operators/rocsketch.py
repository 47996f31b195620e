"""ROC curves and their area in bounded size, with a stated error.

A sketch is a table with a row for each interval of scores: its positive and
negative rows and its least and largest score.  Sketches over the same bounds
merge by sums, so parts of the data, days, or the batches of a stream can be
counted apart.  Every point of a sketch is a point of the exact curve (the rates
at its interval's least score); an interval of one score loses nothing, and
within any other the area is known to half of its (positive × negative) share.
The sum of these halves is the sketch's own error, whatever the data.

``bounds`` finds intervals for an error asked for: quantiles of both classes
first, then intervals that still hold too much are split until they are light or
hold a single score.  Its numbers (some per 1 / error) are all that reaches the
driver.  Rows without a label don't count; a null or NaN score raises.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Intervals that a heavy one is split into.
SPLIT = 16


def _score(score: str) -> Column:
    s = F.col(score).cast("double")
    return F.when(s.isNull() | F.isnan(s), F.raise_error(F.lit("a score is null or NaN")).cast("double")).otherwise(s)


def sketch(df: DataFrame, edges: list[float], score: str = "score", label: str = "label") -> DataFrame:
    """``(bucket, pos, neg, low, high)``: intervals that begin at ``edges`` (rising),
    and one below the first.  Works on batches and on streams."""
    y = F.col(label).cast("double")
    rows = df.filter(y.isNotNull()).select(_score(score).alias("score"), (y == 1.0).alias("is_pos"))
    splits = [-math.inf, *(x for x in edges if math.isfinite(x)), math.inf]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    dealt = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(rows)
    return dealt.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(
        F.sum(F.col("is_pos").cast("long")).alias("pos"), F.sum((~F.col("is_pos")).cast("long")).alias("neg"),
        F.min("score").alias("low"), F.max("score").alias("high"))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows of sketches over the same edges."""
    rows = reduce(DataFrame.unionByName, sketches)
    return rows.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("low").alias("low"), F.max("high").alias("high"))


def _around(low: float, high: float) -> list[float]:
    """Edges that split scores from low to high and part both ends from the rest."""
    ends = [low, math.nextafter(low, math.inf), high, math.nextafter(high, math.inf)]
    if math.isfinite(low) and math.isfinite(high):
        ends += [low + (high / SPLIT - low / SPLIT) * i for i in range(1, SPLIT)]
    return ends


def bounds(df: DataFrame, error: float, score: str = "score", label: str = "label") -> list[float]:
    """Edges for which the sketch of ``df`` has an area known to ``error`` and no
    two neighbouring points further apart than twice that in either rate, but for
    steps of the exact curve itself."""
    if not 0 < error < 1:
        raise ValueError("error must be between 0 and 1")
    y, n = F.col(label).cast("double"), math.ceil(1 / error)
    probs, near = [i / n for i in range(n + 1)], 10 * n
    s = _score(score)
    first = df.filter(y.isNotNull()).agg(*[F.percentile_approx(F.when(c, s), probs, near) for c in (y == 1.0, y != 1.0)]).first()
    edges = {e for part in first for v in part or [] for e in (v, math.nextafter(v, math.inf))}
    while True:
        rows = sketch(df, sorted(edges), score, label)
        total = Window.partitionBy()  # a row per edge, a few per 1 / error
        share = F.greatest(*[F.coalesce(F.try_divide(F.col(c), F.sum(c).over(total)), F.lit(0.0)) for c in ("pos", "neg")])
        heavy = rows.withColumn("share", share).filter((F.col("share") > 2 * error) & (F.col("low") < F.col("high"))).select("low", "high").collect()
        if not heavy:
            return sorted(e for e in edges if math.isfinite(e))
        edges.update(e for r in heavy for e in _around(r["low"], r["high"]))


def points(rows: DataFrame) -> DataFrame:
    """A sketch's points of the exact curve: its columns, and ``threshold``, ``tp``,
    ``fp``, ``tpr``, ``fpr`` of ``score >= threshold``."""
    onward = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)  # a row per edge
    every = Window.partitionBy()
    tp, fp = F.sum("pos").over(onward), F.sum("neg").over(onward)
    return rows.select("*", F.col("low").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                       F.try_divide(tp, F.sum("pos").over(every)).alias("tpr"), F.try_divide(fp, F.sum("neg").over(every)).alias("fpr"))


def auc(rows: DataFrame) -> DataFrame:
    """One row: the sketch's ``auc``, its ``error`` (the exact area is no further
    away), ``n_pos``, ``n_neg``; null where a class has no rows."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per edge
    pairs = F.col("pos").cast("double") * F.col("neg")
    sums = rows.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0))).agg(
        F.sum(F.col("pos").cast("double") * F.col("below") + pairs / 2).alias("area"),
        F.sum(F.when(F.col("low") < F.col("high"), pairs / 2).otherwise(0.0)).alias("open"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"))
    all_pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(F.try_divide(F.col("area"), all_pairs).alias("auc"), F.try_divide(F.col("open"), all_pairs).alias("error"), "n_pos", "n_neg")
