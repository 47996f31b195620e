import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rainfold.operators import serving as V

ANCHOR = dt.datetime(2024, 1, 2, 3, 4)


def _requests(spark, ns):
    return spark.createDataFrame([(i, n) for i, n in enumerate(ns)], "request_id long, n int")


def test_record_count_equals_n(spark):
    ns = list(range(0, 8))
    out = V.horizon(_requests(spark, ns), F.lit(ANCHOR).cast("timestamp_ntz"))
    counts = {r["request_id"]: r["c"] for r in out.groupBy("request_id").agg(F.count("*").alias("c")).collect()}
    for i, n in enumerate(ns):
        assert counts.get(i, 0) == n  # n = 0 gives no rows (sequence would count down)


def test_unpadded_text(spark):
    out = V.horizon(_requests(spark, [2]), F.lit(ANCHOR).cast("timestamp_ntz")).orderBy("h").collect()
    assert [r["Fecha"] for r in out] == ["2024-1-2 3:4", "2024-1-2 4:4"]


def _records(spark, H=6):
    return spark.createDataFrame([(h, f"t{h}", 20.0 + h, 50.0 - h) for h in range(H)],
                                 "h long, Fecha string, Temperatura double, Humedad double")


def test_composition_equals_one_call(spark):
    req = _requests(spark, [0, 1, 3, 5])
    one = sorted(V.answer_requests(req, _records(spark)).collect())
    hours = V.horizon(req, F.lit(ANCHOR).cast("timestamp_ntz")).select("request_id", "h")
    by_hand = sorted(hours.join(_records(spark), "h").select(
        "request_id", "h", "Fecha", "Temperatura", "Humedad").collect())
    assert one == by_hand


def test_json_payload(spark):
    out = {r["request_id"]: r["payload"] for r in V.as_json(_requests(spark, [0, 2]), _records(spark)).collect()}
    assert out[0] == "[]"
    assert out[1] == ('[{"Fecha":"t0","Temperatura":20.0,"Humedad":50.0},'
                      '{"Fecha":"t1","Temperatura":21.0,"Humedad":49.0}]')


@pytest.mark.parametrize("n", [-1, V.MAX_HOURS + 1])
def test_impossible_n_raises(spark, n):
    with pytest.raises(Exception, match="must be between"):
        V.answer_requests(_requests(spark, [n]), _records(spark)).collect()


def test_request_beyond_the_forecast_raises(spark):
    for answer in (V.answer_requests, V.as_json):
        with pytest.raises(Exception, match="exceeds the forecast horizon"):
            answer(_requests(spark, [2, 7]), _records(spark)).collect()


def test_every_request_gets_n_records(spark):
    ns = [0, 1, 24, 25, 30, 48, 100]
    req, rec = _requests(spark, ns), _records(spark, 100)
    counts = {r["request_id"]: r["c"] for r in V.answer_requests(req, rec).groupBy("request_id").agg(F.count("*").alias("c")).collect()}
    assert [counts.get(i, 0) for i in range(len(ns))] == ns
    assert [len(json.loads(r["payload"])) for r in V.as_json(req, rec).orderBy("request_id").collect()] == ns


def test_relabel_by_document_raises_when_payload_short(spark):
    entries = spark.createDataFrame([("a", 0, 1.0, 2.0), ("a", 1, 1.5, 2.5), ("b", 0, 7.0, 8.0)], "doc string, pos long, temp double, humidity double")
    ask = lambda *rows: V.relabel_payload(spark.createDataFrame(list(rows), "request_id long, doc string, n int"), entries, F.lit(ANCHOR).cast("timestamp_ntz"))
    for rows in ([(1, "a", 3)], [(1, "b", 2)], [(1, "a", 1), (2, "none", 1)]):
        with pytest.raises(Exception, match="exceeds payload"):
            ask(*rows).collect()
    got = ask((1, "a", 2), (2, "b", 1), (3, "a", 0)).collect()
    assert sorted((r["request_id"], r["h"], r["Temperatura"]) for r in got) == [(1, 0, 1.0), (1, 1, 1.5), (2, 0, 7.0)]
