"""ROC sketches against the exact curve."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rainfold.operators import metrics as M
from rainfold.operators import rocsketch as K
from rainfold.session import scratch_path


def scores(spark, kind, n=4000, seed=1):
    rng = random.Random(seed)
    draw = {"smooth": lambda y: rng.gauss(0.6 if y else 0.45, 0.2), "hot": lambda y: rng.choice([0.5, 0.5, 0.5, rng.random()]),
            "wide": lambda y: (10.0 ** rng.uniform(-300, 300)) * (1 if y else rng.choice([-1, 1])), "ends": lambda y: rng.choice([-math.inf, 0.0, 1.0, math.inf])}[kind]
    rows = []
    for _ in range(n):
        y = rng.random() < 0.2
        rows.append((int(y), float(draw(y))))
    return spark.createDataFrame(rows, "label int, score double").repartition(3).cache()


@pytest.mark.parametrize("kind", ["smooth", "hot", "wide", "ends"])
def test_area_and_points_hold_the_error_asked_for(spark, kind):
    df, error = scores(spark, kind), 0.02
    edges = K.bounds(df, error)
    rows = K.sketch(df, edges).cache()
    got, exact = K.auc(rows).first(), M.auc_scores(df).first()
    assert abs(got["auc"] - exact["auc"]) <= got["error"] + 1e-12 and got["error"] <= error
    assert (got["n_pos"], got["n_neg"]) == (exact["n_pos"], exact["n_neg"])
    assert len(edges) < 50 / error
    if kind == "ends":
        assert got["error"] == 0
    curve = {r["threshold"]: (r["tp"], r["fp"]) for r in M.roc_points(df).collect()}
    mine = K.points(rows).orderBy("bucket").collect()
    assert all(curve[r["threshold"]] == (r["tp"], r["fp"]) for r in mine)
    for r in mine:
        if r["low"] < r["high"]:
            assert r["pos"] <= 2 * error * got["n_pos"] and r["neg"] <= 2 * error * got["n_neg"]


def test_parts_merge_to_the_whole(spark):
    df = scores(spark, "smooth")
    edges = K.bounds(df, 0.05)
    part = F.pmod(F.xxhash64("score"), F.lit(3))
    merged = K.merge(*[K.sketch(df.filter(part == i), edges) for i in range(3)])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, K.sketch(df, edges).collect()))


def test_a_stream_is_counted_into_the_same_sketch(spark):
    df, path = scores(spark, "hot"), scratch_path(spark, "t-roc-in")
    edges = K.bounds(df, 0.05)
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = K.sketch(stream, edges).writeStream.format("memory").queryName("roc_sketch").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("roc_sketch").collect())) == sorted(map(tuple, K.sketch(df, edges).collect()))


def test_empty_one_class_and_bad_scores(spark):
    empty = spark.createDataFrame([], "score double, label int")
    assert K.bounds(empty, 0.1) == [] and tuple(K.auc(K.sketch(empty, [])).first()) == (None, None, 0, 0)
    one = spark.createDataFrame([(0.1, 1), (0.2, 1), (0.3, None)], "score double, label int")
    assert tuple(K.auc(K.sketch(one, K.bounds(one, 0.1))).first()) == (None, None, 2, 0)
    for bad in (float("nan"), None):
        with pytest.raises(Exception, match="null or NaN"):
            K.sketch(spark.createDataFrame([(bad, 1), (0.5, 0)], "score double, label int"), [0.5]).collect()
    with pytest.raises(ValueError):
        K.bounds(empty, 0.0)
