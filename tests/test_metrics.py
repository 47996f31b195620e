import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rainfold.operators import metrics as M


def _scores(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = rnd.random() < 0.4
        s = round(min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.45, 0.2))), 2)  # ties on purpose
        rows.append((float(y), s))
    return spark.createDataFrame(rows, "label double, score double")


def test_auc_matches_mllib(spark):
    df = _scores(spark)
    ours = M.auc_scores(df, "score", "label", n_buckets=16).first()["auc"]
    vec = df.rdd.map(lambda r: (Vectors.dense([1 - r.score, r.score]), r.label)).toDF(["rawPrediction", "label"])
    ref = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(vec)
    assert abs(ours - ref) < 1e-9


def test_auc_hard_matches_mllib(spark):
    df = _scores(spark).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    ours = M.auc_hard(df, "prediction", "label").first()["auc_hard"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(df)
    assert abs(ours - ref) < 1e-9


def test_roc_points_monotone(spark):
    pts = M.roc_points(_scores(spark), "score", "label").orderBy(F.desc("threshold")).collect()
    tprs = [p["tpr"] for p in pts]
    fprs = [p["fpr"] for p in pts]
    assert tprs == sorted(tprs) and fprs == sorted(fprs)
    assert abs(tprs[-1] - 1.0) < 1e-12 and abs(fprs[-1] - 1.0) < 1e-12


def test_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (0.0, 0), (0.0, 0)], "prediction double, label int")
    r = M.accuracy(df).first()
    assert r["accuracy"] == 0.75 and abs(r["test_error"] - 0.25) < 1e-12 and r["n"] == 4


def test_empty_one_class_and_nan_scores(spark):
    empty = spark.createDataFrame([], "score double, label int")
    assert tuple(M.auc_scores(empty).first()) == (None, 0, 0)
    assert M.roc_points(empty).count() == 0
    one = spark.createDataFrame([(0.1, 1), (0.2, 1), (0.3, None)], "score double, label int")
    assert tuple(M.auc_scores(one).first()) == (None, 2, 0)
    for bad in (float("nan"), None):
        with pytest.raises(Exception, match="null or NaN"):
            M.auc_scores(spark.createDataFrame([(bad, 1), (0.5, 0)], "score double, label int")).first()
