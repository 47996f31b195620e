"""Projection, joins on time, null handling, ordered limits and row positions.

Every function takes and returns DataFrames and stays inside built-in
expressions, so Catalyst can prune columns and push filters into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Keep columns by 1-based position, like ``cut -f 1,4``.

    Selection is by the resolved column objects, so duplicate or dashed
    names are safe.
    """
    cols = df.columns
    for p in positions:
        if p < 1 or p > len(cols):
            raise IndexError(f"position {p} outside 1..{len(cols)}")
    return df.select(*[df[cols[p - 1]] for p in positions])


def select_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep columns by name; names with dashes or dots are quoted."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename (``toDF``), which also resolves duplicate names."""
    return df.toDF(*names)


def join_on_time(left: DataFrame, right: DataFrame, key: str, names: Sequence[str] | None = None,
                 how: str = "inner") -> DataFrame:
    """Equi-join two keyed tables on ``key``; output = key, left rest, right rest.

    Repeated keys multiply as in any relational join; the inputs need not be
    sorted.  ``names`` renames the output positionally (e.g. DATE, HUM, TEMP).
    """
    l_rest = [c for c in left.columns if c != key]
    r_rest = [c for c in right.columns if c != key]
    lk, rk = left.alias("l"), right.alias("r")
    out = lk.join(rk, F.col(f"l.`{key}`") == F.col(f"r.`{key}`"), how).select(
        F.col(f"l.`{key}`").alias(key),
        *[F.col(f"l.`{c}`") for c in l_rest],
        *[F.col(f"r.`{c}`") for c in r_rest],
    )
    return out.toDF(*names) if names else out


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any of ``subset``) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def first_n(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order (``head -n``, made deterministic).

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: every task keeps
    its own top ``n`` and only those reach the final merge, so no full sort or
    shuffle of the input happens.
    """
    return df.orderBy(*order_by).limit(n)


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "series",
            value: str = "y") -> DataFrame:
    """Wide → long (unpivot): one row per (id, value column)."""
    return df.unpivot(list(ids), list(values), name, value)


def hour_floor(ts: str | Column) -> Column:
    """Truncate a wall-clock timestamp to the hour, keeping ``timestamp_ntz``.

    Built from the wall-clock fields, so the session time zone (and its
    daylight-saving gaps) cannot move an hour.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def minute_floor(ts: str | Column) -> Column:
    """Truncate a wall-clock timestamp to the minute (see ``hour_floor``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.lit(0))


def order_seconds(df: DataFrame, col: str) -> Column:
    """Whole seconds since the epoch as an ordering key.

    For wall-clock (``timestamp_ntz``) columns the key is built from the date
    and clock fields alone, so the session time zone and its daylight-saving
    gaps cannot reorder or merge values; instants use ``unix_seconds``.
    """
    c = F.col(col)
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        days = F.unix_date(F.to_date(c)).cast("long")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_seconds(c.cast("timestamp"))


def position_index(df: DataFrame, order_col: str, key: str | None = None, idx: str = "idx",
                   partitions: int | None = None) -> DataFrame:
    """Dense 1-based position of each row within its key, ordered by ``order_col``.

    Equal to ``row_number() over (partition by key order by order_col)``, ties
    going by the hash of the whole row, but no task holds a whole series: rows
    are range-partitioned on (key, order, row hash), so one key, or one hour of
    it, spreads over many partitions by sampled bounds.  Each row's partition id
    is written once below the shared checkpoint folder (two separately planned
    range shuffles could sample different bounds); the counts per (partition,
    key), partitions x keys rows, become offsets, and each piece numbers its own
    rows.  Null keys form a series of their own and null times come first.
    Fully identical rows share a partition, since they cannot be ordered apart.
    """
    from ..session import materialize

    spark = df.sparkSession
    keys = [key] if key else []
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tb = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = materialize(df.withColumn("_tb", tb).repartitionByRange(n, *keys, order_col, "_tb")
                         .withColumn("_pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_pid").alias("_opid"), *[F.col(k).alias("_okey") for k in keys],
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    same = F.col("_pid") == F.col("_opid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_okey"))
    w_local = Window.partitionBy("_pid", *keys).orderBy(order_col, "_tb")
    return (
        ranged.join(offsets, same, "inner")
        .withColumn(idx, (F.col("_off") + F.row_number().over(w_local)).cast("long"))
        .select(*df.columns, idx)
    )


def shifted_lags(df: DataFrame, key: str | None, idx: str, col: str, lags: Sequence[int],
                 prefix: str = "lag", block_rows: int = 100_000) -> DataFrame:
    """Columns ``{prefix}{k}`` = value ``k`` positions earlier (``idx`` dense 1..N per key).

    Equal to ``lag(col, k) over (partition by key order by idx)``, but a long
    series is cut into blocks of ``block_rows`` positions.  The last
    ``max(lags)`` rows of each block are copied into the next block as context,
    so one window per ``(key, block)`` sees every value it needs.  The data is
    shuffled once (plus a ``max(lags) / block_rows`` share of context rows),
    and a series holding a third of all rows is still spread over many tasks.
    """
    keys = [key] if key else []
    kmax = max(lags)
    if kmax >= block_rows:
        raise ValueError("block_rows must exceed the largest lag")
    blk = f"CAST((`{idx}` - 1) DIV {block_rows} AS BIGINT)"
    # One pass: every row is emitted for its own block, and the last kmax rows
    # of a block once more as context for the next block.
    entries = (f"concat(array(named_struct('blk', {blk}, 'ctx', false)), "
               f"CASE WHEN (`{idx}` - 1) % {block_rows} >= {block_rows - kmax} "
               f"THEN array(named_struct('blk', {blk} + 1, 'ctx', true)) "
               f"ELSE CAST(array() AS array<struct<blk: bigint, ctx: boolean>>) END)")
    both = df.selectExpr(*[f"`{c}`" for c in keys], f"`{idx}`", f"`{col}`", f"explode({entries}) AS _e") \
        .selectExpr(*[f"`{c}`" for c in keys], f"`{idx}`", f"`{col}`", "_e.blk AS _blk", "_e.ctx AS _ctx")
    w = Window.partitionBy(*keys, "_blk").orderBy(idx)
    out = both.select(*keys, idx, col, "_ctx", *[F.lag(col, k).over(w).alias(f"{prefix}{k}") for k in lags])
    return out.filter(~F.col("_ctx")).drop("_ctx")
