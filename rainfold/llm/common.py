"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Text handed to numpy at a time, in bytes: bounds a Python worker's memory.
SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(key: str | Column, folds: int, fold: int) -> Column:
    """True where crc32(key as text) mod ``folds`` is ``fold``; a null key trains."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def slices(rows, size: Callable, limit: int = SLICE_BYTES) -> Iterator[list]:
    """Cut an iterable into lists whose sizes sum to about ``limit``; one
    larger element makes a list of its own."""
    out, total = [], 0
    for r in rows:
        n = size(r)
        if out and total + n > limit:
            yield out
            out, total = [], 0
        out.append(r)
        total += n
    if out:
        yield out


def texts(batches, limit: int = SLICE_BYTES, key: int = 0, text: int = 1) -> Iterator[list[tuple]]:
    """(key, text) lists of bounded size from Arrow batches of a key and a
    binary column; a null text is empty."""
    for b in batches:
        keys, col = b.column(key), b.column(text)
        yield from slices(((keys[i].as_py(), col[i].as_py() or b"") for i in range(b.num_rows)), lambda r: len(r[1]) + 64, limit)


def utf8(text: str) -> Column:
    """The text's UTF-8 bytes (Spark keeps strings so; nothing is copied)."""
    return F.col(text).cast("string").cast("binary")


__all__ = ["SLICE_BYTES", "held_out", "materialize", "read", "ship_package", "slices", "texts", "utf8"]
