"""Streaming re-aim of the forecast service: request files → answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..session import materialize, scratch_path
from ..streaming import payloads as PS
from ..streaming import requests as RS
from . import fixtures as X
from . import oracle_sql as O
from .q_io import PAYLOAD_SQL, payload_entries
from .q_serving import ASKED_SQL, asked_horizon, records
from .common import finish
from .registry import register


@register("stream_requests", f"""WITH {ASKED_SQL}
SELECT q.request_id, CAST(t.h AS BIGINT) AS h, r."Fecha", r."Temperatura", r."Humedad"
FROM requests q, range(q.n) t(h) JOIN records r ON r.h = t.h""")
def stream_requests(spark, sf_dir):
    """Requests derived from ``events`` land as JSON files; a streaming query
    answers all of them (available-now trigger) into a Parquet sink."""
    landing = scratch_path(spark, "requests-landing")
    sink = scratch_path(spark, "requests-answers")
    ckpt = scratch_path(spark, "requests-checkpoint")
    X.requests(spark, sf_dir).write.json(landing)
    recs = finish(records(spark, sf_dir, asked_horizon(spark, sf_dir))).cache()
    q = RS.start(spark, landing, recs, sink, ckpt, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    recs.unpersist()
    return spark.read.parquet(sink)


_DAY = "CAST(strptime(doc, '%Y-%m-%d') AS TIMESTAMP)"


@register("stream_payloads", f"""WITH {PAYLOAD_SQL}, {O.REQUESTS},
docs AS (SELECT doc, count(*) AS size, row_number() OVER (ORDER BY doc) - 1 AS no FROM entries GROUP BY doc),
asked AS (
  SELECT request_id, doc, n, size, request_id % 24 AS hour, {_DAY} + (request_id % 24) * INTERVAL 1 HOUR + INTERVAL 30 MINUTE AS asked_at
  FROM requests JOIN docs ON request_id % (SELECT count(*) FROM docs) = no
),
fits AS (SELECT q.*, CAST(t.h AS BIGINT) AS h FROM asked q, range(q.n) t(h) WHERE n <= size AND hour >= 6)
SELECT f.request_id, f.doc, f.h, strftime(asked_at + h * INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M') AS "Fecha",
       round(e.temp + CASE WHEN hour >= 12 THEN 1 ELSE 0 END, 6) AS "Temperatura", round(e.humidity, 6) AS "Humedad", 'ok' AS status
FROM fits f JOIN entries e ON e.doc = f.doc AND e.pos = f.h
UNION ALL
SELECT request_id, doc, NULL, NULL, NULL, NULL, CASE WHEN hour < 6 THEN 'missing' ELSE 'short' END FROM asked WHERE hour < 6 OR n > size""")
def stream_payloads(spark, sf_dir):
    """Two streams: each day's payload is issued at 6:00 and again, one degree up,
    at 12:00, and every user asks for some day's first n entries at some half hour."""
    landing, asked_dir, sink, ckpt = (scratch_path(spark, f"payload-{c}") for c in ("landing", "requests", "answers", "checkpoint"))
    entries = materialize(payload_entries(spark, sf_dir), "entries")
    item = F.struct("pos", F.struct("temp", "humidity").alias("main"))
    docs = materialize(entries.groupBy("doc").agg(F.sort_array(F.collect_list(item)).alias("items"), F.count(F.lit(1)).alias("size")), "docs")
    day = lambda hours: F.to_timestamp("doc") + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0))
    issue = F.explode(F.array(*[F.struct(F.lit(h).alias("hour"), F.lit(up).alias("up")) for h, up in ((6, 0.0), (12, 1.0))]))
    sent = docs.select("doc", "items", issue.alias("i")).select(
        "doc", day(F.col("i.hour")).alias("at"), F.transform("items", lambda x: F.struct(F.struct(
            (x["main"]["temp"] + F.col("i.up")).alias("temp"), x["main"]["humidity"].alias("humidity")).alias("main"))).alias("list"))
    sent.write.json(landing)
    placed = R.position_index(docs.select("doc"), "doc", idx="no")
    no = F.col("request_id") % docs.select(F.count(F.lit(1))).scalar() + 1
    asks = X.requests(spark, sf_dir).withColumn("no", no).join(placed, "no")
    asks.select("request_id", "doc", "n", (day(F.col("request_id") % 24) + F.expr("INTERVAL 30 MINUTES")).alias("at")).write.json(asked_dir)
    # All that landed is drained first, whatever the order of the files (the delay
    # covers the range of times); then an empty payload moves the watermark past it.
    end = docs.agg(F.max("doc").alias("doc")).select(F.lit("end").alias("doc"), day(F.lit(24 * 800)).alias("at"), F.array().cast(f"array<{PS.ENTRY}>").alias("list"))
    for last in (False, True):
        if last:
            end.write.mode("append").json(landing)
        q = PS.start(spark, landing, asked_dir, sink, ckpt, delay="400 days")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return finish(spark.read.parquet(sink))
