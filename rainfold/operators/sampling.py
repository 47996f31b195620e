"""Class counts, rebalancing and repeatable splits.

Positives and negatives are never separated into two scans and re-unioned:
each operator reads its input once.  Fractions derived from the data are
scalar subqueries, so the plan stays lazy and no value round-trips through
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label value (partial aggregation before the shuffle)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_ratio(df: DataFrame, label: str = "label", positive=1) -> DataFrame:
    """One row: total, positives, negatives and positives / total, in one pass."""
    is_pos = F.col(label).eqNullSafe(F.lit(positive)).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(is_pos).alias("n_pos"),
        F.sum(1 - is_pos).alias("n_neg"),
    ).withColumn("ratio", F.try_divide(F.col("n_pos").cast("double"), F.col("n_total")))


def ratio_value(df: DataFrame, label: str = "label", positive=1, ratio: str = "of_total") -> Column:
    """The undersampling fraction as a scalar-subquery column.

    ``of_total``: positives / total, as the reference computes it (the kept
    negatives then stay fewer than the positives).  ``equal``: min(1, P/N),
    which balances the classes in expectation.
    """
    r = class_ratio(df, label, positive)
    if ratio == "of_total":
        expr = F.col("ratio")
    elif ratio == "equal":
        expr = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("n_pos").cast("double"), F.col("n_neg")), F.lit(1.0)))
    else:
        raise ValueError(f"unknown ratio {ratio!r}")
    return r.select(expr).scalar()


def oversample(df: DataFrame, label: str = "label", k: int = 2, positive=1,
               copy_col: str | None = None) -> DataFrame:
    """Every positive row ``k`` times, every other row once, in one scan.

    Same multiset as ``neg ∪ pos ∪ pos`` for k = 2.  ``copy_col`` keeps the
    copy number (1..k) so a later key-hash split can treat copies apart.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    reps = F.when(F.col(label).eqNullSafe(F.lit(positive)), F.lit(k)).otherwise(F.lit(1))
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), reps)))
    return out.withColumnRenamed("_copy", copy_col) if copy_col else out.drop("_copy")


def undersample(df: DataFrame, key: Column, label: str = "label", seed: int = 1234, positive=1,
                ratio: str = "of_total") -> DataFrame:
    """All positives plus the negatives whose key hash falls below the fraction.

    The fraction is a scalar subquery over the same input; the keep decision
    depends on the key only, so the sample repeats exactly.
    """
    frac = ratio_value(df, label, positive, ratio)
    keep = F.col(label).eqNullSafe(F.lit(positive)) | (unit_hash(key, seed) < frac)
    return df.filter(keep)


def undersample_random(df: DataFrame, label: str = "label", seed: int = 1234, positive=1,
                       ratio: str = "of_total") -> DataFrame:
    """Bernoulli undersampling with Spark's sampler.

    Every row that isn't positive (whatever its label, null included) is one
    stratum.  The fraction is computed by one aggregate first (a scalar for the
    sampler); the result depends on partitioning, like the reference's.
    """
    row = class_ratio(df, label, positive).first()
    if ratio == "of_total":
        r = row["ratio"] or 0.0
    else:
        r = min(1.0, row["n_pos"] / row["n_neg"]) if row["n_neg"] else 1.0
    is_pos = F.col(label).eqNullSafe(F.lit(positive))
    return df.filter(is_pos).unionByName(df.filter(~is_pos).sample(False, float(r), seed))


def split_column(key: Column, weights: Sequence[float], seed: int = 1234) -> Column:
    """Split number 0..len(weights)-1 from the key hash and normalised weights."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    u = unit_hash(key, seed)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def split(df: DataFrame, key: Column, weights: Sequence[float] = (0.7, 0.3), seed: int = 1234) -> list[DataFrame]:
    """Key-hash split: a partition of the input that repeats on any cluster."""
    s = split_column(key, weights, seed)
    return [df.filter(s == F.lit(i)) for i in range(len(weights))]


def split_random(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 1234) -> list[DataFrame]:
    """Spark's ``randomSplit`` (depends on partitioning; kept for parity)."""
    return df.randomSplit(list(weights), seed)


#: Bits of the key hash that a round of ``exact_sample`` refines; 60 bits in all.
ROUND_BITS, HASH_BITS = 12, 60


def sample_hash(key: str | Column, seed: int) -> Column:
    """The first 60 bits of ``md5("<seed>:<key>")``."""
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_sample(df: DataFrame, key: str, k: int, seed: int = 1234) -> DataFrame:
    """Exactly ``k`` rows (all, if there are fewer): those of the smallest key
    hashes, equal hashes in the order of their keys, equal keys either.

    The k-th smallest hash is found in five rounds of counts, each over the bucket
    that the last one narrowed it down to, so 4,096 counts a round are all that
    reaches the driver; the same rows come out of any partitioning.  A null key is
    taken after all others.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    limit = 1 << HASH_BITS
    rows = df.withColumn("_hash", F.coalesce(sample_hash(key, seed), F.lit(limit - 1)))
    low, left = 0, k
    for shift in range(HASH_BITS - ROUND_BITS, -1, -ROUND_BITS):
        inside = rows.filter(F.col("_hash").between(low, low + (1 << (shift + ROUND_BITS)) - 1))
        counts = inside.groupBy(F.shiftright("_hash", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect()
        for b, n in counts:
            if left < n:
                low = b << shift
                break
            left -= n
        else:
            return df  # fewer rows than asked for, or exactly as many
    ties = rows.filter(F.col("_hash") == low).orderBy(F.asc_nulls_last(f"`{key}`")).limit(left)
    return rows.filter(F.col("_hash") < low).unionByName(ties).drop("_hash")
