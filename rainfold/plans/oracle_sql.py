"""DuckDB text of the fixtures, used to build oracle queries.

Each oracle query is self-contained: it starts from the driver's base views
and rebuilds the fixture it needs as common table expressions.
"""

from __future__ import annotations

from .fixtures import CITY_COLUMNS


def _wide_sql(name: str, value: str, unit: str = "hour") -> str:
    cols = ",\n    ".join(f"avg(CASE WHEN event_type = '{c}' THEN {value} END) AS {c}" for c in CITY_COLUMNS)
    return f"""{name} AS (
  SELECT date_trunc('{unit}', ts) AS datetime,
    {cols}
  FROM events GROUP BY 1
)"""


WIDE_TEMP = _wide_sql("wide_temp", "value")
WIDE_HUM = _wide_sql("wide_hum", "event_id % 101")

WEATHER = f"""{WIDE_TEMP},
{WIDE_HUM},
weather AS (
  SELECT h.datetime AS "DATE", h.purchase AS "HUM", t.purchase AS "TEMP"
  FROM wide_hum h JOIN wide_temp t ON h.datetime = t.datetime
),
weather_clean AS (SELECT * FROM weather WHERE "HUM" IS NOT NULL AND "TEMP" IS NOT NULL)"""

MINUTES = f"""{_wide_sql("wide_temp", "value", "minute")},
{_wide_sql("wide_hum", "event_id % 101", "minute")},
minutes AS (
  SELECT h.datetime AS "DATE", h.purchase AS "HUM", t.purchase AS "TEMP"
  FROM wide_hum h JOIN wide_temp t ON h.datetime = t.datetime
)"""

SERIES_LONG = f"""{WEATHER},
series_long AS (
  SELECT "DATE", 'TEMP' AS series, "TEMP" AS y FROM weather_clean
  UNION ALL
  SELECT "DATE", 'HUM' AS series, "HUM" AS y FROM weather_clean
),
series_idx AS (
  SELECT series, "DATE", CAST(row_number() OVER (PARTITION BY series ORDER BY "DATE") AS BIGINT) AS idx, y
  FROM series_long
)"""

HOURLY = """hourly AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, avg(value) AS y FROM events GROUP BY 1, 2
),
hourly_idx AS (
  SELECT series, ts, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) AS BIGINT) AS idx, y FROM hourly
)"""

LBL = """lbl AS (
  SELECT CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' ||
         CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) AS hkey,
         l_quantity, l_extendedprice, l_discount, l_tax AS "PSSM_central_-1_S",
         CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
         CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

DOC = """doc AS (
  SELECT d.doc_id,
         CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces,
         CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS n_lines,
         CAST(length(text) - length(replace(text, ',', '')) AS DOUBLE) AS n_commas,
         CAST(length(text) - length(replace(text, '.', '')) AS DOUBLE) AS n_dots,
         CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS is_en,
         l.quality AS label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""

ANCHOR = "(SELECT max(date_trunc('hour', ts)) FROM events)"

REQUESTS = """requests AS (
  SELECT user_id AS request_id, CAST(user_id % 49 AS INTEGER) AS n FROM (SELECT DISTINCT user_id FROM events)
)"""

TS_SERIES = f"""{HOURLY},
steps AS (SELECT date_trunc('hour', ts) AS ts, avg(value) - 50.0 AS step FROM events GROUP BY 1),
running AS (SELECT 'running' AS series, ts, sum(step) OVER (ORDER BY ts) AS y FROM steps),
ts_series AS (SELECT series, ts, y FROM hourly UNION ALL SELECT series, ts, y FROM running),
ts_idx AS (
  SELECT series, ts, CAST(row_number() OVER (PARTITION BY series ORDER BY ts) AS BIGINT) AS idx, y FROM ts_series
),
ts_lag AS (
  SELECT series, idx, y,
         lag(y, 1) OVER w AS l1, lag(y, 2) OVER w AS l2, lag(y, 3) OVER w AS l3
  FROM ts_idx WINDOW w AS (PARTITION BY series ORDER BY idx)
)"""
