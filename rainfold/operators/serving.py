"""Answer "next n hours" requests from forecast tables or payloads.

Requests are a table ``(request_id, n)``.  Each request expands into its
hours ``h = 0..n-1`` with a generator (n = 0 gives no hours), and those rows
meet the forecast by an equi-join on the hour.  A request gets exactly n
records: a negative n, one above ``MAX_HOURS``, and one beyond the stored
forecast all raise.  The forecast side has a row per hour, at most
``MAX_HOURS`` rows, and is broadcast by that bound (a shuffle on the few hours
would be badly skewed: every request has hour 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest n that a request may ask for: ten years of hours.
MAX_HOURS = 87_600


def fecha(ts: Column) -> Column:
    """Unpadded ``Y-M-D H:M`` text, e.g. ``2024-1-2 3:4``."""
    return F.date_format(ts, "yyyy-M-d H:m")


def hour_offsets(n: Column) -> Column:
    """``[0, 1, …, n-1]`` as bigints, empty for n = 0 (``sequence`` would count
    down) and null; n < 0 or n > MAX_HOURS raises."""
    wrong = F.raise_error(F.concat(F.lit(f"a request's n must be between 0 and {MAX_HOURS}, not "), n.cast("string")))
    return F.when((n < 0) | (n > MAX_HOURS), wrong.cast("array<bigint>")).when(
        n > 0, F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def by_hour(records: DataFrame) -> DataFrame:
    """The records for a broadcast: a row per hour, MAX_HOURS at most."""
    return F.broadcast(records.filter(F.col("h") < MAX_HOURS))


def present(value: Column, what: str) -> Column:
    """The value; a null raises: the request exceeds what there is."""
    return F.when(value.isNull(), F.raise_error(F.lit(f"request exceeds {what}")).cast("string")).otherwise(value)


def horizon(requests: DataFrame, anchor: Column, n_col: str = "n") -> DataFrame:
    """One row per request and hour ``h`` in 0..n-1, with its time and text.

    ``sequence(0, n-1)`` would count down for n = 0, so such requests get an
    empty array instead.
    """
    out = requests.select("*", F.explode(hour_offsets(F.col(n_col))).alias("h"))
    ts = anchor + F.make_dt_interval(F.lit(0), F.col("h").cast("int"))
    return out.select("*", ts.alias("ts"), fecha(ts).alias("Fecha"))


def relabel_payload(requests: DataFrame, entries: DataFrame, anchor: Column) -> DataFrame:
    """First n entries of each request's payload, labelled as consecutive hours.

    ``requests`` is (request_id, doc, n), ``entries`` (doc, pos, temp, humidity):
    documents are joined by their key.  A request for more hours than its
    payload holds raises an error.
    """
    hours = horizon(requests, anchor)
    ent = entries.select(F.col("doc").alias("_doc"), F.col("pos").alias("_h"), "temp", "humidity")
    met = hours.join(ent, (F.col("doc") == F.col("_doc")) & (F.col("h") == F.col("_h")), "left")
    fecha_ = F.when(F.col("_h").isNull(), F.raise_error(F.lit("request exceeds payload length")).cast("string")).otherwise(F.col("Fecha"))
    return met.select("request_id", "doc", "h", fecha_.alias("Fecha"),
                      F.col("temp").alias("Temperatura"), F.col("humidity").alias("Humedad"))


def forecast_records(fc: DataFrame, anchor: Column, temp: str = "TEMP", hum: str = "HUM",
                     key: str = "series") -> DataFrame:
    """Pivot two series' forecasts into records ``(h, Fecha, Temperatura, Humedad)``.

    Forecast step ``h`` (1-based) is labelled ``anchor + (h-1)`` hours, as the
    reference labels its i-th value with now + i hours.  The pivot groups by
    the step, so it is a small aggregate over ``series × horizon`` rows.
    """
    h0 = (F.col("h") - 1).cast("long")
    out = fc.groupBy(h0.alias("h")).agg(
        F.max(F.when(F.col(key) == F.lit(temp), F.col("yhat"))).alias("Temperatura"),
        F.max(F.when(F.col(key) == F.lit(hum), F.col("yhat"))).alias("Humedad"))
    ts = anchor + F.make_dt_interval(F.lit(0), F.col("h").cast("int"))
    return out.select("h", fecha(ts).alias("Fecha"), "Temperatura", "Humedad")


def answer_requests(requests: DataFrame, records: DataFrame) -> DataFrame:
    """``(request_id, h, Fecha, Temperatura, Humedad)`` for h < n of each request;
    an hour without a record raises.  Works on streams of requests as well."""
    wanted = requests.select("request_id", F.explode(hour_offsets(F.col("n"))).alias("h"))
    return wanted.join(by_hour(records), "h", "left").select(
        "request_id", "h", present(F.col("Fecha"), "the forecast horizon").alias("Fecha"), "Temperatura", "Humedad")


def as_json(requests: DataFrame, records: DataFrame) -> DataFrame:
    """``(request_id, n, payload)``: each request's records as a JSON array.

    Records are gathered per request (n per group), ordered by hour, and
    serialised with ``to_json``; a request with n = 0 gets ``[]``.
    """
    wanted = requests.select("request_id", "n", F.explode_outer(hour_offsets(F.col("n"))).alias("h"))
    joined = wanted.join(by_hour(records), "h", "left")
    fecha_ = present(F.col("Fecha"), "the forecast horizon").alias("Fecha")
    rec = F.when(F.col("h").isNotNull(), F.struct("h", F.struct(fecha_, "Temperatura", "Humedad").alias("r")))
    grouped = joined.groupBy("request_id", "n").agg(F.sort_array(F.collect_list(rec)).alias("rs"))
    return grouped.select("request_id", "n", F.to_json(F.transform("rs", lambda x: x["r"])).alias("payload"))
