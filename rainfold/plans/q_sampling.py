"""Class filters, counts, rebalancing and splits on the labelled table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import unit_hash_sql
from ..operators import sampling as S
from . import fixtures as X
from . import oracle_sql as O
from .registry import register

SEED = 1234


def _hkey():
    return F.col("hkey")


@register("class_filter", f"WITH {O.LBL} SELECT hkey, label FROM lbl WHERE label = 1")
def class_filter(spark, sf_dir):
    return X.lbl(spark, sf_dir).filter("label = 1").select("hkey", "label")


@register("class_counts", f"WITH {O.LBL} SELECT label, count(*) AS n FROM lbl GROUP BY label")
def class_counts(spark, sf_dir):
    return S.class_counts(X.lbl(spark, sf_dir), "label")


@register("class_ratio", f"""WITH {O.LBL}
SELECT count(*) AS n_total, CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg,
       round(sum(label) / count(*), 6) AS ratio FROM lbl""")
def class_ratio(spark, sf_dir):
    r = S.class_ratio(X.lbl(spark, sf_dir), "label")
    return r.select("n_total", "n_pos", "n_neg", F.round("ratio", 6).alias("ratio"))


@register("union_all", f"""WITH {O.LBL}
SELECT hkey, label FROM lbl WHERE label = 1 UNION ALL SELECT hkey, label FROM lbl WHERE label = 0""")
def union_all(spark, sf_dir):
    """Positional bag union of the two class subsets (the reference's reassembly)."""
    df = X.lbl(spark, sf_dir).select("hkey", "label")
    return df.filter("label = 1").unionAll(df.filter("label = 0"))


@register("oversample", f"""WITH {O.LBL}
SELECT hkey, label, 1 AS copy FROM lbl
UNION ALL SELECT hkey, label, 2 AS copy FROM lbl WHERE label = 1""")
def oversample(spark, sf_dir):
    """Each positive twice, each negative once, in one scan."""
    out = S.oversample(X.lbl(spark, sf_dir).select("hkey", "label"), "label", k=2, copy_col="copy")
    return out.withColumn("copy", F.col("copy").cast("int"))


@register("undersample_hash", f"""WITH {O.LBL},
r AS (SELECT sum(label) / count(*) AS ratio FROM lbl)
SELECT hkey, label FROM lbl, r WHERE label = 1 OR {unit_hash_sql('hkey', SEED)} < r.ratio""")
def undersample_hash(spark, sf_dir):
    """All positives plus negatives kept with probability P/(P+N), by key hash."""
    return S.undersample(X.lbl(spark, sf_dir).select("hkey", "label"), _hkey(), "label", seed=SEED)


@register("split_hash", f"""WITH {O.LBL}
SELECT hkey, label, CASE WHEN {unit_hash_sql('hkey', SEED)} < 0.7 THEN 0 ELSE 1 END AS split FROM lbl""")
def split_hash(spark, sf_dir):
    """70/30 split by key hash, as a split number per row (a partition of the input)."""
    df = X.lbl(spark, sf_dir).select("hkey", "label")
    return df.withColumn("split", S.split_column(_hkey(), [0.7, 0.3], SEED).cast("int"))


@register("undersample_mllib", f"""WITH {O.LBL}
SELECT CAST(sum(label) AS BIGINT) AS positives, 0 AS strangers, 0 AS repeats, true AS share_fits FROM lbl""")
def undersample_mllib(spark, sf_dir):
    """Bernoulli undersampling with Spark's sampler: all positives stay, no row
    comes from elsewhere or twice, and the share of negatives fits the fraction
    (within five standard deviations)."""
    df = X.lbl(spark, sf_dir).select("hkey", "label")
    out = S.undersample_random(df, "label", seed=SEED).groupBy("hkey", "label").agg(F.count(F.lit(1)).alias("n"))
    facts = S.class_ratio(df, "label")
    both = df.groupBy("hkey", "label").agg(F.count(F.lit(1)).alias("m")).join(out, ["hkey", "label"], "full")
    counted = both.agg(
        F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("positives"), F.sum(F.col("m").isNull().cast("int")).cast("int").alias("strangers"),
        F.sum((F.col("n") > F.col("m")).cast("int")).cast("int").alias("repeats"), F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("kept"))
    mean = facts.select(F.struct((F.col("n_neg") * F.col("ratio")).alias("mean"), F.sqrt(F.col("n_neg") * F.col("ratio") * (1 - F.col("ratio"))).alias("sd"))).scalar()
    fits = F.abs(F.coalesce("kept", F.lit(0)) - mean["mean"]) <= 5 * mean["sd"] + 1
    return counted.select("positives", "strangers", F.coalesce("repeats", F.lit(0)).alias("repeats"), fits.alias("share_fits"))


@register("split_random", f"""WITH {O.LBL}
SELECT count(*) AS n, 0 AS missing, 0 AS repeats, true AS share_fits FROM lbl""")
def split_random(spark, sf_dir):
    """Spark's ``randomSplit`` 70/30 with seed 1234: the parts make up the input,
    share no row, and their sizes fit (within five standard deviations)."""
    df = X.lbl(spark, sf_dir).select("hkey", "label")
    train, test = S.split_random(df, [0.7, 0.3], SEED)
    parts = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    got = parts.groupBy("hkey", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("part").alias("test"))
    both = df.groupBy("hkey", "label").agg(F.count(F.lit(1)).alias("m")).join(got, ["hkey", "label"], "full")
    counted = both.agg(F.sum("n").alias("n"), F.sum(F.greatest(F.coalesce("m", F.lit(0)) - F.coalesce("n", F.lit(0)), F.lit(0))).cast("int").alias("missing"),
                       F.sum(F.greatest(F.coalesce("n", F.lit(0)) - F.coalesce("m", F.lit(0)), F.lit(0))).cast("int").alias("repeats"), F.sum("test").alias("test"))
    return counted.select("n", "missing", "repeats", (F.abs(F.col("test") - 0.3 * F.col("n")) <= 5 * F.sqrt(0.21 * F.col("n")) + 1).alias("share_fits"))


SAMPLED = 5000


@register("sample_exact", f"""WITH {O.LBL}
SELECT hkey, label FROM lbl ORDER BY ('0x' || substr(md5('77:' || hkey), 1, 15))::BIGINT, hkey LIMIT {SAMPLED}""")
def sample_exact(spark, sf_dir):
    """Exactly 5,000 rows of the labelled table by their keys' hashes."""
    return S.exact_sample(X.lbl(spark, sf_dir).select("hkey", "label"), "hkey", SAMPLED, 77)
