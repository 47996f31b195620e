"""Repeatable pseudo-random numbers from row keys.

``unit_hash`` maps ``md5("<seed>:<key>")`` to [0, 1) using its first 32 bits.
The value depends only on the key text and the seed, never on partitioning
or row order, so samples and splits repeat across runs, executor losses and
engines (DuckDB computes the same number from the same text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def key_text(cols: Sequence[str | Column], sep: str = ":") -> Column:
    """Join key columns as text; integers only, so every engine prints them alike."""
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def unit_hash(key: Column, seed: int) -> Column:
    """Uniform-looking number in [0, 1) from a key column and a seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def unit_hash_sql(key_sql: str, seed: int) -> str:
    """The same number as DuckDB SQL text (used by the oracle queries)."""
    return f"(('0x' || substr(md5('{seed}:' || ({key_sql})), 1, 8))::BIGINT / 4294967296.0)"
