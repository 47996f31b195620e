import json

import pytest

from rainfold.session import scratch_path
from rainfold.sources import stored as ST
from rainfold.streaming import payloads as P


class Landing:
    def __init__(self, spark):
        self.spark = spark
        self.payloads, self.requests, self.sink, self.ckpt = (scratch_path(spark, f"t-{c}") for c in ("payloads", "requests", "answers", "ckpt"))
        self.send([]), self.ask([])

    def send(self, rows):
        lines = [json.dumps({"doc": d, "at": f"2024-01-01 {at}", "list": [{"main": {"temp": t, "humidity": 50.0}} for t in temps]}) for d, at, temps in rows]
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(self.payloads)

    def ask(self, rows):
        lines = [json.dumps({"request_id": i, "doc": d, "n": n, "at": f"2024-01-01 {at}"}) for i, d, n, at in rows]
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(self.requests)

    def run(self):
        q = P.start(self.spark, self.payloads, self.requests, self.sink, self.ckpt)
        q.awaitTermination()
        assert q.exception() is None
        return sorted(((r["request_id"], r["h"], r["Fecha"], r["Temperatura"], r["status"]) for r in self.spark.read.parquet(self.sink).collect()), key=repr)


def test_requests_wait_for_the_latest_payload_of_their_time(spark):
    at = Landing(spark)
    at.ask([(1, "a", 2, "10:30:00"), (2, "a", 1, "09:00:00"), (3, "gone", 1, "10:00:00"), (4, "a", 5, "10:30:00"), (5, "a", 0, "10:00:00")])
    at.send([("a", "08:00:00", [1.0, 2.0]), ("a", "10:00:00", [3.0, 4.0]), ("a", "11:00:00", [9.0, 9.0])])
    assert at.run() == [(2, 0, "2024-1-1 9:0", 1.0, "ok")]  # the watermark is at 10:00
    # within the delay: arrives late, but before the watermark has passed the request
    at.send([("a", "10:15:00", [5.0, 6.0]), ("a", "10:00:00", [3.0, 4.0])])
    at.send([("clock", "14:00:00", [])])
    want = [(1, 0, "2024-1-1 10:30", 5.0, "ok"), (1, 1, "2024-1-1 11:30", 6.0, "ok"), (2, 0, "2024-1-1 9:0", 1.0, "ok"), (3, None, None, None, "missing"), (4, None, None, None, "short")]
    assert at.run() == want
    # behind the watermark: dropped; repeated and restarted: nothing again
    at.send([("a", "10:20:00", [7.0, 8.0])])
    at.ask([(1, "a", 2, "10:30:00")])
    assert at.run() == want
    at.ask([(6, "a", 1, "15:00:00")])
    at.send([("clock", "18:00:00", [])])
    assert at.run() == sorted([*want, (6, 0, "2024-1-1 15:0", 9.0, "ok")], key=repr)


def test_many_requests_of_one_document_are_dealt_into_shares(spark):
    at = Landing(spark)
    at.send([("hot", "08:00:00", [1.5]), ("clock", "20:00:00", [])])
    at.ask([(i, "hot", 1, "09:00:00") for i in range(200)])
    got = at.run()
    assert len(got) == 200 and {r[3:] for r in got} == {(1.5, "ok")}


@pytest.mark.parametrize("n", [0, 1, 7, 25, 999])
def test_first_rows_in_stored_order_open_only_the_first_files(spark, n):
    path = scratch_path(spark, "t-stored")
    rows = [((i * 37) % 100, f"v{i}") for i in range(60)]
    for k in range(6):
        spark.createDataFrame(rows[k * 10:k * 10 + 10], "id long, v string").coalesce(1).write.mode("append").option("header", True).csv(f"{path}/d{k}")
    # one folder, files named in order
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    flat = scratch_path(spark, "t-flat")
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(flat))
    for k in range(6):
        (f,) = ST.files(spark, f"{path}/d{k}")
        fs.rename(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.hadoop.fs.Path(f"{flat}/part-{k}.csv"))
    opened = []

    def read(files):
        opened.extend(files)
        return spark.read.schema("id long, v string").option("header", True).csv(list(files))

    got = [tuple(r) for r in ST.first_stored(spark, flat, n, read, ".csv").collect()]
    assert sorted(got) == sorted(rows[:n])
    assert len(set(opened)) == max(1, min(6, -(-n // 10)))


def test_stored_order_within_a_file_of_several_splits(spark):
    path = scratch_path(spark, "t-splits")
    spark.range(20_000).selectExpr("(id * 7919) % 20000 AS id", "repeat('x', 50) AS v").coalesce(1).write.csv(path)
    want = [(i * 7919) % 20000 for i in range(15_000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = ST.first_stored(spark, path, 15_000, lambda f: spark.read.schema("id long, v string").csv(list(f)), ".csv")
        assert sorted(r["id"] for r in got.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
