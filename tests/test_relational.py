import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rainfold.operators import relational as R


def _series(spark, n=500, keys=("a", "b", "c")):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(minutes=7 * i + j), float((i * 31 + j) % 17))
            for j, k in enumerate(keys) for i in range(n)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double")


def test_position_index_equals_row_number(spark):
    df = _series(spark)
    got = R.position_index(df, "ts", key="series")
    want = df.withColumn("idx", F.row_number().over(Window.partitionBy("series").orderBy("ts")).cast("long"))
    a = sorted(got.select("series", "ts", "idx").collect())
    b = sorted(want.select("series", "ts", "idx").collect())
    assert a == b


def test_shifted_lags_equal_window_lag(spark):
    df = R.position_index(_series(spark, 200), "ts", key="series")
    got = R.shifted_lags(df.select("series", "idx", "y"), "series", "idx", "y", [1, 2, 5])
    w = Window.partitionBy("series").orderBy("idx")
    want = df.select("series", "idx", "y", *[F.lag("y", k).over(w).alias(f"lag{k}") for k in (1, 2, 5)])
    cols = ["series", "idx", "y", "lag1", "lag2", "lag5"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_select_positions_and_duplicates(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "t int, a double, b double, c double")
    out = R.select_positions(df, [1, 4])
    assert out.columns == ["t", "c"]
    with pytest.raises(IndexError):
        R.select_positions(df, [5])
    j = R.join_on_time(out, out, "t", ["DATE", "HUM", "TEMP"])
    assert j.columns == ["DATE", "HUM", "TEMP"] and j.collect()[0] == (1, 4.0, 4.0)


def test_first_n_is_ordered_limit(spark):
    df = spark.range(100).withColumn("k", (F.col("id") * 37) % 100)
    rows = R.first_n(df, 5, ["k"]).collect()
    assert [r["k"] for r in rows] == [0, 1, 2, 3, 4]
    plan = R.first_n(df, 5, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_drop_any_null_joint(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 2.0), (3, 1.0, None)], "t int, h double, x double")
    assert [r["t"] for r in R.drop_any_null(df).collect()] == [2]


def test_shifted_lags_across_blocks(spark):
    df = R.position_index(_series(spark, 300), "ts", key="series")
    got = R.shifted_lags(df.select("series", "idx", "y"), "series", "idx", "y", [1, 3, 7], block_rows=16)
    w = Window.partitionBy("series").orderBy("idx")
    want = df.select("series", "idx", "y", *[F.lag("y", k).over(w).alias(f"lag{k}") for k in (1, 3, 7)])
    cols = ["series", "idx", "y", "lag1", "lag3", "lag7"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_position_index_range_with_hot_bucket(spark):
    base = dt.datetime(2024, 1, 1)
    # one key holds most rows, all inside a single hour bucket
    rows = [("hot", base + dt.timedelta(microseconds=37 * i), float(i % 11)) for i in range(3000)]
    rows += [(k, base + dt.timedelta(minutes=i), 1.0) for k in ("a", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double")
    got = R.position_index(df, "ts", key="series", partitions=16)
    want = df.withColumn("idx", F.row_number().over(Window.partitionBy("series").orderBy("ts")).cast("long"))
    assert sorted(got.select("series", "ts", "idx").collect()) == sorted(want.select("series", "ts", "idx").collect())


def test_position_index_across_dst_gap(spark):
    # wall-clock hours through the US spring-forward gap (02:00-03:00 does not exist locally)
    base = dt.datetime(2024, 3, 10, 0, 0)
    rows = [("s", base + dt.timedelta(minutes=30 * i), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = R.position_index(df, "ts", key="series")
        assert sorted((r["y"], r["idx"]) for r in got.collect()) == [(float(i), i + 1) for i in range(12)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_order_seconds_wall_clock_and_instant(spark):
    rows = [(dt.datetime(2024, 3, 10, h, 30),) for h in range(5)]  # through the US spring-forward gap
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        keys = [r["k"] for r in df.select(R.order_seconds(df, "ts").alias("k")).orderBy("ts").collect()]
        assert keys == sorted(keys) and len(set(keys)) == 5 and all(b - a == 3600 for a, b in zip(keys, keys[1:]))
        inst = df.select(F.col("ts").cast("timestamp").alias("t"))
        got = inst.select(R.order_seconds(inst, "t").alias("k"), F.unix_seconds("t").alias("u")).collect()
        assert all(r["k"] == r["u"] for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_position_index_keeps_null_keys_and_times(spark):
    rows = [("a", 1), ("a", 2), (None, 1), (None, None), ("a", None), (None, 5), ("a", 2)]
    df = spark.createDataFrame(rows, "series string, ts int")
    got = R.position_index(df, "ts", key="series", partitions=3).collect()
    assert sorted((str(r["series"]), r["idx"]) for r in got) == [("None", 1), ("None", 2), ("None", 3), ("a", 1), ("a", 2), ("a", 3), ("a", 4)]
    assert [r["ts"] for r in sorted(got, key=lambda r: r["idx"]) if r["series"] is None] == [None, 1, 5]
