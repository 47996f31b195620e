from pyspark.sql import functions as F

from rainfold.session import checkpoint_base, local_path, materialize, scratch_scope


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id")).filter("id % 3 = 0")
    m = materialize(df, "t")
    assert sorted(m.collect()) == sorted(df.collect())
    assert "FileScan parquet" in _plan(m)
    base = local_path(checkpoint_base(spark))
    assert local_path(m.inputFiles()[0]).lstrip("/").startswith(base.lstrip("/") + "/rainfold-scratch/")


def test_scratch_scope_removes_what_was_made_inside(spark):
    import os

    outside = materialize(spark.range(3), "outside")
    with scratch_scope(spark):
        inside = materialize(spark.range(5), "inside")
        assert inside.count() == 5
        path = os.path.dirname(local_path(inside.inputFiles()[0]))
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    assert outside.count() == 3
