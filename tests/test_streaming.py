from rainfold.session import scratch_path
from rainfold.streaming import requests as RS


def test_restart_resumes_without_duplicates(spark):
    landing = scratch_path(spark, "t-landing")
    sink = scratch_path(spark, "t-sink")
    ckpt = scratch_path(spark, "t-ckpt")
    recs = spark.createDataFrame([(h, f"t{h}", 1.0 * h, 2.0 * h) for h in range(6)],
                                 "h long, Fecha string, Temperatura double, Humedad double")
    spark.createDataFrame([(1, 2), (2, 0)], RS.REQUEST_SCHEMA).write.mode("append").json(landing)
    RS.start(spark, landing, recs, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    spark.createDataFrame([(3, 3)], RS.REQUEST_SCHEMA).write.mode("append").json(landing)
    RS.start(spark, landing, recs, sink, ckpt).awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert sorted((r["request_id"], r["h"]) for r in rows) == [(1, 0), (1, 1), (3, 0), (3, 1), (3, 2)]
