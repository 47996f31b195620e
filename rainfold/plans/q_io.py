"""Sources and sinks: headed CSV, zipped CSV, stored tables, JSON payloads.

Files are written below the session's shared checkpoint folder, each run in
a fresh location, and read back by the same query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..session import materialize, scratch_path
from ..sources import batches, csvfiles, jsondocs, stored, zipcsv
from . import fixtures as X
from . import oracle_sql as O
from .common import finish
from .q_weather import weather, weather_clean
from .registry import register

LBL_COLS = ["hkey", *X.LBL_FEATURES, "label"]
_LBL_SELECT = ", ".join(
    ["hkey"] + [f'round("{c}", 6) AS "{c}"' for c in X.LBL_FEATURES] + ["label"])


@register("csv_roundtrip", f"WITH {O.LBL} SELECT {_LBL_SELECT} FROM lbl")
def csv_roundtrip(spark, sf_dir):
    """Write the labelled table as headed CSV, read it back with type inference."""
    path = scratch_path(spark, "csv")
    csvfiles.write_csv(X.lbl(spark, sf_dir), path)
    return finish(csvfiles.read_csv(spark, path))


@register("project_names", f"""WITH {O.LBL}
SELECT hkey, round(l_quantity, 6) AS l_quantity, round("PSSM_central_-1_S", 6) AS "PSSM_central_-1_S",
       round(p_size, 6) AS p_size, label AS class FROM lbl""")
def project_names(spark, sf_dir):
    """Projection by names (one with a dash), then an aliasing ``selectExpr``."""
    df = R.select_names(X.lbl(spark, sf_dir), ["hkey", "l_quantity", "PSSM_central_-1_S", "p_size", "label"])
    return finish(df.selectExpr("hkey", "l_quantity", "`PSSM_central_-1_S` AS `PSSM_central_-1_S`",
                                "p_size", "label AS class"))


@register("project_sql_view", f"""WITH {O.LBL}
SELECT hkey, round(l_quantity, 6) AS l_quantity, round("PSSM_central_-1_S", 6) AS "PSSM_central_-1_S",
       round(p_size, 6) AS p_size, label AS class FROM lbl""")
def project_sql_view(spark, sf_dir):
    """The same projection as SQL over a temporary view (names quoted with backticks)."""
    view = f"lbl_view_{abs(hash(sf_dir)) % 10**8}"
    X.lbl(spark, sf_dir).createOrReplaceTempView(view)
    return finish(spark.sql(
        f"SELECT hkey, l_quantity, `PSSM_central_-1_S`, p_size, label AS class FROM {view}"))


WIDE_DDL = "datetime timestamp_ntz, " + ", ".join(f"{c} double" for c in X.CITY_COLUMNS)


@register("zip_csv_source", f"""WITH {O.WIDE_TEMP}
SELECT datetime, round(purchase, 6) AS purchase FROM wide_temp""")
def zip_csv_source(spark, sf_dir):
    """Zipped headed CSV → lines → typed rows → positions 1 and 4."""
    path = scratch_path(spark, "zipcsv")
    zipcsv.write_zip_csv(X.wide_temp(spark, sf_dir), path)
    wide = zipcsv.read_zip_csv(spark, path, WIDE_DDL)
    return finish(R.select_positions(wide, [1, X.WANTED_POSITION]))


@register("table_replace_load", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM weather""")
def table_replace_load(spark, sf_dir):
    """Headed CSV files → typed table, columns by the header's names, loaded
    twice with replace semantics: no duplicate rows."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "table")
    csvfiles.write_csv(weather(spark, sf_dir), landing)
    for _ in range(2):
        csvfiles.load_table(spark, landing, path, "DATE timestamp_ntz, HUM double, TEMP double")
    return finish(csvfiles.read_table(spark, path))


@register("table_export_fields", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM weather_clean""")
def table_export_fields(spark, sf_dir):
    """Stored table → export DATE, HUM, TEMP as headed CSV → read back → drop incomplete."""
    table_path = scratch_path(spark, "store")
    out_path = scratch_path(spark, "export")
    csvfiles.replace_table(weather(spark, sf_dir), table_path)
    csvfiles.export_fields(csvfiles.read_table(spark, table_path), ["DATE", "HUM", "TEMP"], out_path)
    back = csvfiles.read_csv(spark, out_path, schema="DATE timestamp_ntz, HUM double, TEMP double")
    return finish(R.drop_any_null(back))


@register("table_append_batches", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP", 'part-' || CAST(day("DATE") % 3 AS VARCHAR) AS batch FROM weather""")
def table_append_batches(spark, sf_dir):
    """Three batches appended, each of them twice: the second time nothing changes."""
    path = scratch_path(spark, "batches")
    rows = materialize(weather(spark, sf_dir), "weather")
    for turn in range(2):
        for k in range(3):
            added = batches.append(rows.filter(F.dayofmonth("DATE") % 3 == k), path, f"part-{k}")
            assert added == (turn == 0)
    return finish(batches.read(spark, path).withColumn("batch", F.col("batch").cast("string")))


STORED_N = 400


@register("first_stored_rows", f"""WITH {O.WEATHER}
SELECT "DATE", round("HUM", 6) AS "HUM", round("TEMP", 6) AS "TEMP" FROM (
  SELECT * FROM weather ORDER BY md5(strftime("DATE", '%Y-%m-%d %H:%M:%S')) LIMIT {STORED_N}) WHERE "HUM" IS NOT NULL AND "TEMP" IS NOT NULL""")
def first_stored_rows(spark, sf_dir):
    """The first rows of a stored export whose times are in no order, by their place
    in its files, then the null drop."""
    path = scratch_path(spark, "stored")
    key = F.md5(F.date_format("DATE", "yyyy-MM-dd HH:mm:ss"))
    shuffled = weather(spark, sf_dir).repartitionByRange(6, key).sortWithinPartitions(key)
    csvfiles.write_csv(shuffled, path)
    read = lambda files: spark.read.schema("DATE timestamp_ntz, HUM double, TEMP double").option("header", True).csv(list(files))
    return finish(R.drop_any_null(stored.first_stored(spark, path, STORED_N, read, ".csv")))


def payload_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly entries of the joined table, grouped per day (≤ 24 per document)."""
    w = weather(spark, sf_dir)
    day = F.date_format("DATE", "yyyy-MM-dd")
    return w.select(
        day.alias("doc"),
        (F.row_number().over(Window.partitionBy(day).orderBy("DATE")) - 1).cast("long").alias("pos"),
        F.date_format("DATE", "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
        F.col("TEMP").alias("temp"),
        F.col("HUM").alias("humidity"),
    )


def payload_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "payload")
    jsondocs.write_payloads(payload_entries(spark, sf_dir), path, "doc", "pos")
    return jsondocs.read_payloads(spark, path)


PAYLOAD_SQL = f"""{O.WEATHER},
entries AS (
  SELECT strftime("DATE", '%Y-%m-%d') AS doc,
         CAST(row_number() OVER (PARTITION BY strftime("DATE", '%Y-%m-%d') ORDER BY "DATE") - 1 AS BIGINT) AS pos,
         strftime("DATE", '%Y-%m-%d %H:%M:%S') AS dt_txt, "TEMP" AS temp, "HUM" AS humidity
  FROM weather
)"""


@register("json_forecast_flatten", f"""WITH {PAYLOAD_SQL}
SELECT doc, pos, dt_txt, round(temp, 6) AS temp, round(humidity, 6) AS humidity FROM entries""")
def json_forecast_flatten(spark, sf_dir):
    """Nested JSON documents → one row per entry with ``main.temp``, ``main.humidity``."""
    return finish(jsondocs.flatten_payload(payload_docs(spark, sf_dir)))


@register("json_forecast_relabel", f"""WITH {PAYLOAD_SQL}, {O.REQUESTS},
docs AS (SELECT doc, count(*) AS size, row_number() OVER (ORDER BY doc) - 1 AS no FROM entries GROUP BY doc),
asked AS (
  SELECT request_id, doc, n % (size + 1) AS n FROM requests JOIN docs ON request_id % (SELECT count(*) FROM docs) = no
),
hours AS (SELECT request_id, doc, CAST(h AS BIGINT) AS h FROM asked, range(n) t(h))
SELECT q.request_id, q.doc, q.h,
       strftime({O.ANCHOR} + q.h * INTERVAL 1 HOUR, '%Y-%-m-%-d %-H:%-M') AS "Fecha",
       round(e.temp, 6) AS "Temperatura", round(e.humidity, 6) AS "Humedad"
FROM hours q JOIN entries e ON e.doc = q.doc AND e.pos = q.h""")
def json_forecast_relabel(spark, sf_dir):
    """The first n entries of the payload that each request names (the users'
    requests are dealt over all days' payloads), relabelled as hours from the anchor."""
    from ..operators import serving

    entries = materialize(jsondocs.flatten_payload(payload_docs(spark, sf_dir)), "entries")
    docs = materialize(R.position_index(entries.groupBy("doc").agg(F.count(F.lit(1)).alias("size")), "doc", idx="no"), "docs")
    users = X.requests(spark, sf_dir)
    no = F.col("request_id") % docs.select(F.count(F.lit(1))).scalar() + 1
    asked = users.withColumn("no", no).join(docs, "no").select("request_id", "doc", (F.col("n") % (F.col("size") + 1)).cast("int").alias("n"))
    return finish(serving.relabel_payload(asked, entries, X.latest_hour(spark, sf_dir)))
