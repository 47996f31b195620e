"""Headed CSV in and out, and table replace-load / field export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
             header: bool = True) -> DataFrame:
    """Headed CSV.  With ``schema`` no inference pass is made (prefer it at scale);
    without it, types are inferred like ``inferSchema=True`` (one extra job)."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """Headed CSV; by default fails when the path exists, like a plain ``write.csv``."""
    df.write.mode(mode).option("header", header).csv(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace-load: a rerun overwrites instead of appending duplicates."""
    df.write.mode("overwrite").format(fmt).save(path)


def load_table(spark: SparkSession, csv_path: str, path: str, types: StructType | str | None = None, fmt: str = "parquet") -> None:
    """Replace-load from headed CSV: the header names the columns, ``types`` gives
    their types by name (columns it doesn't name stay text; None infers all)."""
    if types is None:
        rows = read_csv(spark, csv_path)
    else:
        wanted = types if isinstance(types, StructType) else StructType.fromDDL(types)
        kinds = {f.name: f.dataType for f in wanted}
        rows = spark.read.option("header", True).csv(csv_path)
        rows = rows.select(*[rows[f"`{c}`"].cast(kinds[c]).alias(c) if c in kinds else rows[f"`{c}`"] for c in rows.columns])
    replace_table(rows, path, fmt)


def read_table(spark: SparkSession, path: str, fields: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a stored table, optionally a field list (pruned at the scan)."""
    df = spark.read.format(fmt).load(path)
    return df.select(*[f"`{f}`" for f in fields]) if fields else df


def export_fields(df: DataFrame, fields: Sequence[str], path: str, mode: str = "overwrite") -> None:
    """Write chosen fields as headed CSV (the export side of the store)."""
    df.select(*[f"`{f}`" for f in fields]).write.mode(mode).option("header", True).csv(path)
