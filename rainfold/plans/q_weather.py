"""Weather pipeline: wide hourly tables → two positions → join on time →
rename → drop incomplete rows → first rows / long form / positions / lags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as R
from ..session import materialize
from . import fixtures as X
from . import oracle_sql as O
from .common import finish
from .registry import register


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HUM ⋈ TEMP on time, each cut to positions 1 and 4, renamed DATE, HUM, TEMP."""
    hum = R.select_positions(X.wide_hum(spark, sf_dir), [1, X.WANTED_POSITION])
    temp = R.select_positions(X.wide_temp(spark, sf_dir), [1, X.WANTED_POSITION])
    return R.join_on_time(hum, temp, "datetime", ["DATE", "HUM", "TEMP"])


def weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_any_null(weather(spark, sf_dir))


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both series of the cleaned join in one keyed table (series, DATE, y)."""
    return R.to_long(weather_clean(spark, sf_dir), ["DATE"], ["TEMP", "HUM"], "series", "y")


def series_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the two weather series; the long table (one row per series
    and hour) is written once so both passes of the index read it, not the
    raw events."""
    return R.position_index(materialize(series_long(spark, sf_dir), "series-long"), "DATE", key="series", idx="idx")


@register("project_positions", f"""WITH {O.WIDE_TEMP}
SELECT datetime, round(purchase, 6) AS purchase FROM wide_temp""")
def project_positions(spark, sf_dir):
    return finish(R.select_positions(X.wide_temp(spark, sf_dir), [1, X.WANTED_POSITION]))


@register("weather_join", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM weather""")
def weather_join(spark, sf_dir):
    return finish(weather(spark, sf_dir))


@register("drop_any_null", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM weather_clean""")
def drop_any_null(spark, sf_dir):
    return finish(weather_clean(spark, sf_dir))


FIRST_N = 999


def _first_sql(n: int) -> str:
    return f"""WITH {O.MINUTES}, head AS (SELECT * FROM minutes ORDER BY "DATE" LIMIT {n})
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM head WHERE "HUM" IS NOT NULL AND "TEMP" IS NOT NULL"""


def _first_complete(spark, sf_dir, n):
    """The first n rows of the joined minute tables in time order, of which the
    incomplete ones are then dropped: fewer than n remain."""
    hum, temp = (R.select_positions(df, [1, X.WANTED_POSITION]) for df in X.wide_minutes(spark, sf_dir))
    joined = R.join_on_time(hum, temp, "datetime", ["DATE", "HUM", "TEMP"])
    return finish(R.drop_any_null(R.first_n(joined, n, ["DATE"])))


@register("first_n_rows", _first_sql(FIRST_N))
def first_n_rows(spark, sf_dir):
    """999 rows (1,000 lines with the header), then the null drop."""
    return _first_complete(spark, sf_dir, FIRST_N)


@register("first_2n_rows", _first_sql(2 * FIRST_N + 1))
def first_2n_rows(spark, sf_dir):
    """The same with 1,999 rows."""
    return _first_complete(spark, sf_dir, 2 * FIRST_N + 1)


@register("series_long", f"""WITH {O.SERIES_LONG}
SELECT "DATE", series, round(y, 6) AS y FROM series_long""")
def q_series_long(spark, sf_dir):
    return finish(series_long(spark, sf_dir))


@register("series_index", f"""WITH {O.SERIES_LONG}
SELECT series, "DATE", idx, round(y, 6) AS y FROM series_idx""")
def series_index(spark, sf_dir):
    return finish(series_indexed(spark, sf_dir).select("series", "DATE", "idx", "y"))


@register("lag_diff", f"""WITH {O.SERIES_LONG},
lagged AS (
  SELECT series, idx, y,
         lag(y, 1) OVER (PARTITION BY series ORDER BY idx) AS lag1,
         lag(y, 2) OVER (PARTITION BY series ORDER BY idx) AS lag2
  FROM series_idx
)
SELECT series, idx, round(y, 6) AS y, round(lag1, 6) AS lag1, round(lag2, 6) AS lag2,
       round(y - lag1, 6) AS diff1, round(y - 2 * lag1 + lag2, 6) AS diff2
FROM lagged""")
def lag_diff(spark, sf_dir):
    s = series_indexed(spark, sf_dir).select("series", "idx", "y")
    lagged = R.shifted_lags(s, "series", "idx", "y", [1, 2])
    return finish(lagged.select(
        "series", "idx", "y", "lag1", "lag2",
        (F.col("y") - F.col("lag1")).alias("diff1"),
        (F.col("y") - 2 * F.col("lag1") + F.col("lag2")).alias("diff2"),
    ))
