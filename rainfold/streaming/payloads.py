"""Forecast payloads and requests for them as they arrive (Structured Streaming).

Payloads ``(doc, at, list)`` and requests ``(request_id, doc, n, at)`` land as JSON
lines.  A request gets the first n entries of its document's latest payload of
its own time or before, labelled as consecutive hours from that time.  It waits in
the state until the watermark has passed its time, so the answer doesn't depend on
the order in which rows arrive, and is given once.

* A payload sent again changes nothing; of two for one time the larger text counts.
* Rows later than the watermark are dropped, as in any stream with a watermark.
* A request whose document has no payload by then is answered ``missing``, one for
  more entries than there are ``short``, both without an hour; n = 0 has no rows.

State is kept per document and share of its requests (payloads go to every share),
so a document that a third of all requests ask for is spread over tasks; of
the payloads that the watermark has passed only the latest is kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.serving import MAX_HOURS, fecha
from ..session import ship_package

ENTRY = "struct<main: struct<temp: double, humidity: double>>"
PAYLOADS = f"doc string, at timestamp, list array<{ENTRY}>"
REQUESTS = "request_id long, doc string, n int, at timestamp"
ANSWERS = "request_id long, doc string, h long, ms long, temp double, humidity double, status string"
STATE = "payloads string, waiting string"
#: Parts that a document's requests are dealt into.
SHARES = 16


def _rows(payloads: DataFrame, requests: DataFrame) -> DataFrame:
    """Both streams in one layout: (doc, share, at, ms, request_id, n, entries)."""
    values = F.to_json(F.transform("list", lambda x: F.array(x["main"]["temp"], x["main"]["humidity"])))
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    sent = payloads.select("doc", shares.alias("share"), "at", F.lit(None).cast("long").alias("request_id"), F.lit(None).cast("int").alias("n"),
                           F.coalesce(values, F.lit("[]")).alias("entries"))
    asked = requests.select("doc", F.pmod(F.xxhash64("request_id"), F.lit(SHARES)).cast("int").alias("share"), "at", "request_id", "n", F.lit(None).cast("string").alias("entries"))
    return sent.unionByName(asked).filter("at IS NOT NULL AND doc IS NOT NULL").withColumn("ms", F.unix_millis("at"))


def _answer(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    old = state.get if state.exists else ("[]", "[]")
    payloads, waiting = {int(ms): e for ms, e in json.loads(old[0])}, {tuple(w) for w in json.loads(old[1])}
    for pdf in parts:
        for r in pdf.itertuples(index=False):
            if r.entries is not None:
                payloads[int(r.ms)] = max(payloads.get(int(r.ms), ""), r.entries)
            else:
                waiting.add((int(r.ms), int(r.request_id), int(r.n)))
    passed = state.getCurrentWatermarkMs()
    ready = sorted(w for w in waiting if w[0] < passed)
    out = []
    for ms, request, n in ready:
        at = max((t for t in payloads if t <= ms), default=None)
        entries = json.loads(payloads[at]) if at is not None else []
        if at is None or n > len(entries) or not 0 <= n <= MAX_HOURS:
            out.append((request, key[0], None, ms, None, None, "missing" if at is None else "short"))
        else:
            out += [(request, key[0], h, ms, *entries[h], "ok") for h in range(n)]
    waiting.difference_update(ready)
    last = max((t for t in payloads if t < passed), default=None)
    kept = {t: e for t, e in payloads.items() if last is None or t >= last}
    state.update((json.dumps(sorted(kept.items())), json.dumps(sorted(waiting))))
    if waiting:
        state.setTimeoutTimestamp(max(min(w[0] for w in waiting) + 1, passed + 1))
    if out:
        pdf = pd.DataFrame(out, columns=["request_id", "doc", "h", "ms", "temp", "humidity", "status"])
        yield pdf.astype({"h": "Int64", "temp": "float64", "humidity": "float64"})


def answers(payloads: DataFrame, requests: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``(request_id, doc, h, Fecha, Temperatura, Humedad, status)`` of two streams;
    ``delay``: how late a row may be."""
    ship_package(requests.sparkSession)
    rows = _rows(payloads, requests).withWatermark("at", delay)
    found = rows.groupBy("doc", "share").applyInPandasWithState(_answer, ANSWERS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    hour = F.timestamp_millis("ms") + F.make_dt_interval(F.lit(0), F.col("h").cast("int"))
    return found.select("request_id", "doc", "h", F.when(F.col("h").isNotNull(), fecha(hour)).alias("Fecha"), F.col("temp").alias("Temperatura"),
                        F.col("humidity").alias("Humedad"), "status")


def start(spark: SparkSession, payload_dir: str, request_dir: str, sink: str, checkpoint: str, delay: str = "1 hour",
          max_files_per_trigger: int = 1000, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Answer what lands in the two folders into a Parquet sink.  A restarted query
    goes on from its checkpoint: no answer is lost or given twice."""
    source = lambda schema, path: spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).json(path)
    writer = answers(source(PAYLOADS, payload_dir), source(REQUESTS, request_dir), delay).writeStream.format("parquet") \
        .option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
