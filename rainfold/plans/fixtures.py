"""Inputs of the reference's shapes, derived by Spark from the driver's tables.

* ``wide_temp`` / ``wide_hum``: hourly wide sensor tables, one column per
  "city" (event type); the wanted city is position 4 (``purchase``).
* ``lbl``: lineitem ⋈ part with six numeric features and a 0/1 label.
* ``doc``: labels ⋈ documents with six text features and label ``quality``.
* ``requests``: one forecast request per user, ``n = user_id % 49`` hours (0 to 48).

All of them grow with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import key_text
from ..operators.relational import hour_floor, minute_floor, order_seconds

# The wide table's columns in position order, and the feature
# names of the classification table (one renamed feature keeps a dashed name
# in play, as in the reference's data).
CITY_COLUMNS = ["click", "error", "purchase", "signup", "view"]
WANTED_POSITION = 4
LBL_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "PSSM_central_-1_S", "p_size", "p_retailprice"]
DOC_FEATURES = ["n_chars", "n_spaces", "n_lines", "n_commas", "n_dots", "is_en"]


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy DataFrame.

    Opening a Parquet source runs a small schema-discovery job; the plan is
    kept per application and path so pipelines that read a table several
    times open it once (the data itself is not cached).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _wide(events: DataFrame, value: Column, floor=hour_floor) -> DataFrame:
    return events.groupBy(floor("ts").alias("datetime")).agg(
        *[F.avg(F.when(F.col("event_type") == F.lit(c), value)).alias(c) for c in CITY_COLUMNS]
    )


def wide_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(table(spark, sf_dir, "events"), F.col("value"))


def wide_hum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(table(spark, sf_dir, "events"), F.col("event_id") % 101)


def wide_minutes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The wide humidity and temperature tables by the minute: long, with many nulls."""
    ev = table(spark, sf_dir, "events")
    return (_wide(ev, F.col("event_id") % 101, minute_floor), _wide(ev, F.col("value"), minute_floor))


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed series ``(series, ts, y)``: mean event value per type and hour."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("series"), hour_floor("ts").alias("ts")).agg(
        F.avg("value").alias("y"))


def latest_hour(spark: SparkSession, sf_dir: str) -> Column:
    """Anchor time: the latest hour in ``events`` (a scalar subquery)."""
    return table(spark, sf_dir, "events").select(hour_floor(F.max("ts"))).scalar()


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast requests ``(request_id, n)``: one per distinct user."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(F.col("user_id").alias("request_id"), (F.col("user_id") % 49).cast("int").alias("n"))


def lbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part → (hkey, six features, label)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        key_text(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).alias("hkey"),
        "l_quantity", "l_extendedprice", "l_discount",
        F.col("l_tax").alias("PSSM_central_-1_S"),
        F.col("p_size").cast("double").alias("p_size"),
        "p_retailprice",
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("label"),
    )


def _count_of(text: Column, s: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))).cast("double")


def doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels ⋈ documents → (doc_id, six text features, label = quality)."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = lab.join(d, "doc_id", "inner")
    t = F.col("text")
    return j.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        _count_of(t, " ").alias("n_spaces"),
        _count_of(t, "\n").alias("n_lines"),
        _count_of(t, ",").alias("n_commas"),
        _count_of(t, ".").alias("n_dots"),
        F.when(F.col("lang") == F.lit("en"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("is_en"),
        F.col("quality").alias("label"),
    )


def running_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``running``: running sum of (hourly mean of all events − 50), a random walk."""
    from ..operators.metrics import running_totals

    ev = table(spark, sf_dir, "events")
    hourly = ev.groupBy(hour_floor("ts").alias("ts")).agg((F.avg("value") - 50.0).alias("step"))
    keyed = hourly.withColumn("ts_key", order_seconds(hourly, "ts").cast("double"))
    out = running_totals(keyed, "ts_key", ["step"])
    return out.select(F.lit("running").alias("series"), "ts", F.col("cum_step").alias("y"))


def ts_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All modelled series: hourly mean per event type, plus the random walk."""
    return hourly_series(spark, sf_dir).unionByName(running_series(spark, sf_dir))


def lbl_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part with label ``l_extendedprice·(1 − l_discount) > 30000``
    (the workload of the baseline's orientation timings)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        key_text(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).alias("hkey"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.col("p_size").cast("double").alias("p_size"), "p_retailprice",
        ((F.col("l_extendedprice") * (1 - F.col("l_discount"))) > 30000).cast("int").alias("label"),
    )


PRICE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice"]


def lbl_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part with a label that a tree of two splits knows exactly:
    ``l_discount >= 0.05 and l_tax < 0.04`` (11 and 9 distinct values)."""
    rule = (F.col("l_discount") >= 0.05) & (F.col("PSSM_central_-1_S") < 0.04)
    return lbl(spark, sf_dir).withColumn("label", rule.cast("int"))
