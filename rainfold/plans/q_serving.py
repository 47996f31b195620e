"""Forecast serving: hours from an anchor, forecast records, request answers
and JSON payloads.  Forecasts here come from AR(1) fits of the two weather
series, which have a closed form the oracle can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lagsums as S
from ..operators import relational as R
from ..operators import serving as V
from ..operators import timeseries as T
from . import fixtures as X
from . import oracle_arima as A
from . import oracle_sql as O
from .common import finish
from .q_weather import series_indexed
from .registry import register

HORIZON = 24


def asked_horizon(spark, sf_dir) -> int:
    """Hours that the requests need at most (one number reaches the driver)."""
    return max(1, X.requests(spark, sf_dir).agg(F.max("n")).first()[0] or 0)


@register("horizon_hours", f"""WITH {O.REQUESTS}
SELECT request_id, n, CAST(h AS BIGINT) AS h, {O.ANCHOR} + h * INTERVAL 1 HOUR AS ts,
       strftime({O.ANCHOR} + h * INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M') AS "Fecha"
FROM requests, range(n) t(h)""")
def horizon_hours(spark, sf_dir):
    """Each request's next n hours from the anchor, with unpadded date text."""
    return V.horizon(X.requests(spark, sf_dir), X.latest_hour(spark, sf_dir))


def weather_forecasts(spark, sf_dir, horizon=HORIZON):
    lag = T.lag_table(series_indexed(spark, sf_dir).withColumnRenamed("DATE", "ts"), "series", "idx", "y", 1)
    return T.forecast(T.ar1_as_model(T.ar1_fit(lag, "series")), horizon)


def records(spark, sf_dir, horizon=HORIZON):
    """``(h, Fecha, Temperatura, Humedad)``: step h+1 labelled anchor + h hours."""
    fc = weather_forecasts(spark, sf_dir, horizon)
    return V.forecast_records(fc, X.latest_hour(spark, sf_dir), "TEMP", "HUM")


def records_sql(hours: str) -> str:
    """``records``: forecast records for the given number of hours (SQL text)."""
    return f"""{O.SERIES_LONG},
lagged AS (SELECT series, idx, y, lag(y, 1) OVER (PARTITION BY series ORDER BY idx) AS l1 FROM series_idx),
ar1 AS (
  SELECT series, regr_slope(y, l1) AS phi, regr_intercept(y, l1) AS c, max_by(y, idx) AS y_last
  FROM lagged GROUP BY series
),
fc AS (
  SELECT series, CAST(h - 1 AS BIGINT) AS h,
         c * (1 - pow(phi, h)) / (1 - phi) + pow(phi, h) * y_last AS yhat
  FROM ar1, range(1, (SELECT CAST({hours} + 1 AS BIGINT))) t(h)
),
records AS (
  SELECT h, strftime({O.ANCHOR} + h * INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M') AS "Fecha",
         round(max(CASE WHEN series = 'TEMP' THEN yhat END), 6) AS "Temperatura",
         round(max(CASE WHEN series = 'HUM' THEN yhat END), 6) AS "Humedad"
  FROM fc GROUP BY h
)"""


RECORDS_SQL = records_sql(str(HORIZON))
ASKED_SQL = f"{O.REQUESTS}, {records_sql('(SELECT greatest(max(n), 1) FROM requests)')}"


@register("forecast_records", f"WITH {RECORDS_SQL} SELECT * FROM records")
def forecast_records(spark, sf_dir):
    """Both series' forecasts side by side as (Fecha, Temperatura, Humedad) records."""
    return finish(records(spark, sf_dir))


@register("forecast_requests", f"""WITH {ASKED_SQL}
SELECT q.request_id, CAST(t.h AS BIGINT) AS h, r."Fecha", r."Temperatura", r."Humedad"
FROM requests q, range(q.n) t(h) JOIN records r ON r.h = t.h""")
def forecast_requests(spark, sf_dir):
    """Every request answered with its first n forecast records."""
    return V.answer_requests(X.requests(spark, sf_dir), finish(records(spark, sf_dir, asked_horizon(spark, sf_dir))))


@register("forecast_json", f"""WITH {ASKED_SQL},
ans AS (
  SELECT q.request_id, q.n, t.h, r."Fecha", r."Temperatura", r."Humedad"
  FROM requests q, range(q.n) t(h) JOIN records r ON r.h = t.h
)
SELECT q.request_id, q.n,
       coalesce((SELECT CAST(to_json(list({{'Fecha': a."Fecha", 'Temperatura': a."Temperatura",
                                          'Humedad': a."Humedad"}} ORDER BY a.h)) AS VARCHAR)
                 FROM ans a WHERE a.request_id = q.request_id), '[]') AS payload
FROM requests q""")
def forecast_json(spark, sf_dir):
    """One JSON array of records per request (``[]`` for n = 0)."""
    return V.as_json(X.requests(spark, sf_dir), finish(records(spark, sf_dir, asked_horizon(spark, sf_dir))))


_ARIMA_WEATHER = A.forecasts(HORIZON, source=f"{O.SERIES_LONG},\nts_idx AS (SELECT series, idx, y FROM series_idx)")


@register("arima_forecast_records", f"""WITH RECURSIVE {_ARIMA_WEATHER}
SELECT h - 1 AS h, strftime({O.ANCHOR} + (h - 1) * INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M') AS "Fecha",
       round(max(CASE WHEN series = 'TEMP' THEN yhat END), 6) AS "Temperatura", round(max(CASE WHEN series = 'HUM' THEN yhat END), 6) AS "Humedad" FROM fc GROUP BY h""")
def arima_forecast_records(spark, sf_dir):
    """End to end: weather join → complete rows → ARIMA order search per series
    (TEMP, HUM) → 24 forecast records with Fecha, Temperatura, Humedad."""
    models = S.models(S.summary(series_indexed(spark, sf_dir).select("series", "idx", "y")))
    return finish(V.forecast_records(T.forecast(models, HORIZON), X.latest_hour(spark, sf_dir), "TEMP", "HUM"))
