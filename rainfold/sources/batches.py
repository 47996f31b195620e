"""Appending to a stored table in batches that can be run again.

A table is a folder with a folder of Parquet files for each batch, named by it.
A batch is written beside them under a hidden name and gets its own name by one
rename when it is whole, so

* a half-written batch is invisible to readers, and a rerun writes it anew;
* a batch that is there changes nothing, however often it is rerun;
* of two writers of one batch the first rename counts, the other's files go.

This needs a file system that renames a folder in one step (HDFS, local disks).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH = "batch"


def _folder(path: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9.-]+", batch):
        raise ValueError(f"a batch's name must consist of letters, digits, dots and dashes, not {batch!r}")
    return f"{path.rstrip('/')}/{BATCH}={batch}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, path: str) -> list[str]:
    """The names of a table's batches, in their order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[len(BATCH) + 1:] for n in names if n.startswith(f"{BATCH}="))


def append(df: DataFrame, path: str, batch: str) -> bool:
    """Add ``df`` as ``batch``; False, and nothing is written, if it is there already."""
    spark, target = df.sparkSession, _folder(path, batch)
    fs, final = _fs(spark, target)
    if fs.exists(final):
        return False
    name = f"_writing-{uuid.uuid4().hex}"
    _, hidden = _fs(spark, f"{path.rstrip('/')}/{name}")
    df.write.mode("errorifexists").parquet(str(hidden.toString()))
    done = fs.rename(hidden, final)
    # a rename onto a folder that came up meanwhile fails, or moves into it
    _, inside = _fs(spark, f"{target}/{name}")
    if done and not fs.exists(inside):
        return True
    fs.delete(inside if done else hidden, True)
    return False


def read(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """All batches with their names in a column ``batch``, or one of them without."""
    if batch is not None:
        return spark.read.parquet(_folder(path, batch))
    reader = spark.read.option("basePath", path)
    folders = [_folder(path, b) for b in committed(spark, path)]
    if not folders:
        raise ValueError(f"no batch below {path}")
    return reader.parquet(*folders)
