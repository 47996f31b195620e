import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rainfold.operators import sampling as S


def _labelled(spark, labels):
    return spark.createDataFrame([(str(i), int(l)) for i, l in enumerate(labels)], "k string, label int")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=60), st.integers(1, 4))
def test_oversample_count(spark, labels, k):
    df = _labelled(spark, labels)
    p = sum(labels)
    assert S.oversample(df, "label", k=k).count() == len(labels) - p + k * p


def test_split_is_a_partition(spark):
    df = _labelled(spark, [i % 3 == 0 for i in range(500)])
    a, b = S.split(df, F.col("k"), [0.7, 0.3], seed=7)
    ka = {r["k"] for r in a.collect()}
    kb = {r["k"] for r in b.collect()}
    assert not (ka & kb) and len(ka | kb) == 500
    assert 300 < len(ka) < 400
    # repeatable: same seed, same split
    a2, _ = S.split(df.repartition(7), F.col("k"), [0.7, 0.3], seed=7)
    assert {r["k"] for r in a2.collect()} == ka


def test_undersample_keeps_all_positives(spark):
    df = _labelled(spark, [i % 4 == 0 for i in range(800)])
    out = S.undersample(df, F.col("k"), "label", seed=3)
    rows = out.collect()
    assert sum(r["label"] for r in rows) == 200
    neg = sum(1 for r in rows if r["label"] == 0)
    assert 90 < neg < 210  # about 600 · 200/800 = 150


def test_class_ratio_one_pass(spark):
    df = _labelled(spark, [1, 0, 0, 1, 1])
    r = S.class_ratio(df, "label").first()
    assert (r["n_total"], r["n_pos"], r["n_neg"]) == (5, 3, 2) and abs(r["ratio"] - 0.6) < 1e-12


def test_random_undersampling_keeps_every_class_in_play(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["yes"] * 300 + ["no"] * 600 + ["maybe"] * 600 + [None] * 600)], "id int, label string")
    got = {r["label"]: r["n"] for r in S.class_counts(S.undersample_random(df, "label", positive="yes")).collect()}
    assert got["yes"] == 300
    assert all(40 < got[x] < 140 for x in ("no", "maybe", None))  # 300 / 2100 of 600


def test_oversample_rejects_no_copies(spark):
    with pytest.raises(ValueError):
        S.oversample(spark.range(3).withColumn("label", F.lit(1)), k=0)


def test_exact_sample_has_exactly_k_rows_whatever_the_partitions(spark):
    import hashlib

    from rainfold.operators import sampling as S

    keys = [f"k{i % 700}" for i in range(1000)] + [None] * 5
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")
    order = sorted(keys, key=lambda k: (2**60 - 1, "~") if k is None else (int(hashlib.md5(f"7:{k}".encode()).hexdigest()[:15], 16), k))
    for k in (0, 1, 2, 499, 1000, 1003, 1005, 9999):
        for parts in (1, 7):
            got = [r["key"] for r in S.exact_sample(df.repartition(parts), "key", k, 7).collect()]
            assert sorted(got, key=str) == sorted(order[:k], key=str), k
