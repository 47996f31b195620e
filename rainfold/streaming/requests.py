"""Answer forecast requests as they arrive (Structured Streaming).

The reference serves "next n hours" through an HTTP route; here requests
land as JSON-lines files in a folder.  A streaming query reads them with an
explicit schema, expands each request into its hours with a generator and
joins the static forecast records (stream–static equi-join on the hour), and
writes answers to a Parquet sink.  Progress and sink metadata live in a
checkpoint folder, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.serving import answer_requests

REQUEST_SCHEMA = "request_id long, n int"


def request_stream(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .json(landing))


def answers(requests: DataFrame, records: DataFrame) -> DataFrame:
    """``(request_id, h, Fecha, Temperatura, Humedad)`` for h < n of each request.

    ``records`` is static, a row per forecast hour, and broadcast to every
    micro-batch; a request beyond the stored horizon fails the batch.
    """
    return answer_requests(requests, records)


def start(spark: SparkSession, landing: str, records: DataFrame, sink: str, checkpoint: str,
          available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the answering query.  ``available_now`` drains what has landed and
    stops (batch-like runs); otherwise it runs on a processing-time trigger."""
    writer = (answers(request_stream(spark, landing), records).writeStream.format("parquet")
              .option("path", sink).option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
