"""Classification metrics as DataFrame aggregations.

Accuracy and the hard-label AUC are conditional averages in one aggregate.
The score AUC and ROC points need running totals over the score order; the
scores are first reduced to distinct values with class counts (a partial
aggregate), written once (the quantile pass, the bucket totals and the
running sums all read that small table instead of recomputing the scores),
then running totals are computed per score bucket and stitched with bucket
offsets, so no single task holds all scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Buckets at least; more where the session shuffles to more partitions.
N_BUCKETS = 256


def _buckets(df: DataFrame, n_buckets: int | None) -> int:
    return n_buckets or max(N_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: ``accuracy``, ``test_error`` and ``n``."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n")).select(
        "accuracy", (1.0 - F.col("accuracy")).alias("test_error"), "n")


def accuracy_and_auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy, test error and hard-label AUC in one aggregate (one pass)."""
    p = F.col(prediction).cast("double")
    y = F.col(label).cast("double")
    hit = (p == y).cast("double")
    return df.agg(
        F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"),
        F.avg(F.when(y == 1.0, p)).alias("tpr"), F.avg(F.when(y == 0.0, 1.0 - p)).alias("tnr"),
    ).select("accuracy", (1.0 - F.col("accuracy")).alias("test_error"), "n",
             ((F.col("tpr") + F.col("tnr")) / 2.0).alias("auc_hard"))


def auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """AUC of 0/1 predictions: the ROC has one inner point, so AUC = (TPR + TNR) / 2."""
    p = F.col(prediction).cast("double")
    y = F.col(label).cast("double")
    return df.agg(
        F.avg(F.when(y == 1.0, p)).alias("tpr"),
        F.avg(F.when(y == 0.0, 1.0 - p)).alias("tnr"),
    ).select(((F.col("tpr") + F.col("tnr")) / 2.0).alias("auc_hard"), "tpr", "tnr")


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with their positive and negative counts.

    Rows without a label don't count; a missing or NaN score raises.
    """
    y = F.col(label).cast("double")
    s = F.col(score).cast("double")
    s = F.when(s.isNull() | F.isnan(s), F.raise_error(F.lit("a score is null or NaN")).cast("double")).otherwise(s)
    return df.filter(y.isNotNull()).groupBy(s.alias("score")).agg(
        F.sum(F.when(y == 1.0, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y == 1.0, 0).otherwise(1)).cast("long").alias("neg"),
    )


def running_totals(df: DataFrame, order_col: str, cols: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` over ascending ``order_col`` (distinct values).

    Bucket bounds are approximate quantiles (``n_buckets`` numbers, 256 or the
    session's shuffle partitions, reach the driver); each bucket sums its own rows, offsets come from the bucket
    totals (``n_buckets`` rows), and the window runs inside each bucket.
    """
    n_buckets = _buckets(df, n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.select(F.percentile_approx(order_col, probs, 10000).alias("b")).first()["b"] or []
    splits = [float("-inf"), *(sorted(set(float(b) for b in bounds if math.isfinite(b))) or [0.0]), float("inf")]
    b = Bucketizer(splits=splits, inputCol=order_col, outputCol="_bucket", handleInvalid="keep").transform(df)
    totals = b.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    w_prev = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(w_prev), F.lit(0)).alias(f"_o_{c}")
                                         for c in cols])
    w_in = Window.partitionBy("_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offsets), "_bucket", "inner")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.sum(c).over(w_in))
    return out.drop("_bucket", *[f"_o_{c}" for c in cols])


def auc_scores(df: DataFrame, score: str = "score", label: str = "label", n_buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve from scores (trapezoids; ties count one half).

    Null if a class has no rows.  AUC = Σ_s pos_s · (negatives below s + neg_s / 2) / (P · N).
    """
    sc = materialize(score_counts(df, score, label), "score-counts")
    cum = running_totals(sc, "score", ["neg"], n_buckets)
    below = F.col("cum_neg") - F.col("neg")
    return cum.agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2.0)).alias("_num"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
    ).select(F.try_divide(F.col("_num"), (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("auc"),
             "n_pos", "n_neg")


def roc_points(df: DataFrame, score: str = "score", label: str = "label", n_buckets: int | None = None) -> DataFrame:
    """One row per distinct threshold t: counts and rates of ``score >= t``."""
    sc = materialize(score_counts(df, score, label), "score-counts")
    cum = running_totals(sc, "score", ["pos", "neg"], n_buckets)
    totals = sc.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N")).alias("t")).select("t").scalar()
    p_all, n_all = totals["P"], totals["N"]
    tp = (p_all - (F.col("cum_pos") - F.col("pos"))).cast("double")
    fp = (n_all - (F.col("cum_neg") - F.col("neg"))).cast("double")
    return cum.select(
        F.col("score").alias("threshold"), tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
        F.try_divide(tp, p_all).alias("tpr"), F.try_divide(fp, n_all).alias("fpr"),
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, p_all).alias("recall"))
