"""Nested JSON forecast payloads: ``{"list": [{"main": {"temp", "humidity"}}]}``.

Payloads are JSON-lines documents in a landing folder (one document per
line, so files split across tasks).  Fetching them over HTTP is not part of
this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = (
    "doc string, list array<struct<dt_txt: string, main: struct<temp: double, humidity: double>>>"
)


def read_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read payload documents with an explicit schema (no inference pass)."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line).json(path)


def flatten_payload(docs: DataFrame) -> DataFrame:
    """One row per list entry: ``doc, pos, dt_txt, temp, humidity`` (nested access)."""
    return docs.select("doc", F.posexplode("list").alias("pos", "item")).select(
        "doc",
        F.col("pos").cast("long").alias("pos"),
        F.col("item.dt_txt").alias("dt_txt"),
        F.col("item.main.temp").alias("temp"),
        F.col("item.main.humidity").alias("humidity"),
    )


def write_payloads(entries: DataFrame, path: str, doc: str, pos: str) -> None:
    """Group entries into documents (one per ``doc`` value) and write JSON lines.

    ``entries`` needs columns ``doc``, ``pos``, ``dt_txt``, ``temp``,
    ``humidity``.  One document holds one group's entries only, so its size is
    bounded by the grouping (e.g. 24 hourly entries per day).
    """
    item = F.struct(
        F.col(pos).alias("pos"),
        F.struct(F.col("dt_txt").alias("dt_txt"),
                 F.struct(F.col("temp").alias("temp"), F.col("humidity").alias("humidity")).alias("main")).alias("e"),
    )
    docs = entries.groupBy(F.col(doc).alias("doc")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    docs.select("doc", F.transform("items", lambda x: x["e"]).alias("list")).write.mode("overwrite").json(path)
