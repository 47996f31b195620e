"""The first rows of stored files in the order they are stored in.

The counterpart of ``head`` on an export without an order column: files go by
their names, the rows of a file by the split they are read in and their place there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: Place of a row within its split: the low bits of Spark's row ids.
_PLACE = (1 << 33) - 1


def files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """The data files directly below ``path`` by name (hidden ones aren't data)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p) if s.isFile()]
    return [full for name, full in sorted(found) if name[0] not in "_." and name.endswith(suffix)]


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of one file read with its metadata, with their order: ``_split`` and ``_place``."""
    return rows.select("*", F.col("_metadata.file_block_start").alias("_split"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place"))


def first_stored(spark: SparkSession, path: str, n: int, read: Callable[[Sequence[str]], DataFrame], suffix: str = "") -> DataFrame:
    """The first ``n`` rows below ``path``; ``read`` makes a DataFrame of some files.

    Files are opened one after the other until there are enough rows, so those
    behind are never read.  Within a file every task keeps its first ``n`` rows
    only (``TakeOrderedAndProject``).
    """
    if n < 0:
        raise ValueError("n must not be negative")
    found = files(spark, path, suffix)
    if not found:
        raise ValueError(f"no files below {path}")
    columns = read(found[:1]).columns
    taken, left = [], n
    for file in found:
        if left <= 0:
            break
        part = materialize(in_order(read([file])).orderBy("_split", "_place").limit(left), "first-stored")
        taken.append(part)
        left -= part.count()
    if not taken:
        return read(found[:1]).limit(0)
    out = taken[0]
    for part in taken[1:]:
        out = out.unionByName(part)
    return out.select(*[F.col(f"`{c}`") for c in columns])
