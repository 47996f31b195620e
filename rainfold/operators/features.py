"""Feature preparation: vectors, label indexes, categorical detection.

MLlib transformers are used where a model needs them; each also has a
relational form (plain aggregates and joins) that the oracle can check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Numeric columns → one vector column (a null fails unless ``handle_invalid``)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def label_index_table(df: DataFrame, col: str, order: str = "frequencyDesc") -> DataFrame:
    """``(label, n, idx)``: the index StringIndexer would assign.

    ``frequencyDesc``: most frequent first, ties by label text;
    ``alphabetAsc``: by label text.  Labels are compared as text, like MLlib.
    Null labels get no index.  The window runs over the distinct labels only (a
    handful for a classifier).
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if order == "frequencyDesc":
        w = Window.orderBy(F.desc("n"), F.asc("label"))
    elif order == "frequencyAsc":
        w = Window.orderBy(F.asc("n"), F.asc("label"))
    elif order == "alphabetAsc":
        w = Window.orderBy(F.asc("label"))
    elif order == "alphabetDesc":
        w = Window.orderBy(F.desc("label"))
    else:
        raise ValueError(order)
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))


def apply_label_index(df: DataFrame, mapping: DataFrame, col: str, out: str = "indexedLabel",
                      handle_invalid: str = "error") -> DataFrame:
    """Attach the index of ``col`` as a double.

    A null or unknown label raises (``error``), gets the index after the last
    one (``keep``) or loses its row (``skip``), as with StringIndexer.  The
    mapping has a row per label; its shuffle is measured, and AQE broadcasts it
    if it is small.
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(handle_invalid)
    m = mapping.select(F.col("label").alias("_lbl"), F.col("idx").cast("double").alias("_idx"))
    joined = df.join(m, F.col(col).cast("string") == F.col("_lbl"), "inner" if handle_invalid == "skip" else "left")
    missing = (F.raise_error(F.concat(F.lit(f"label without an index in {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("null"))))
               if handle_invalid == "error" else mapping.select(F.count(F.lit(1)).cast("double")).scalar())
    return joined.withColumn(out, F.when(F.col("_idx").isNull(), missing).otherwise(F.col("_idx")).cast("double")).drop("_lbl", "_idx")


def labels_array(mapping: DataFrame) -> Column:
    """Labels in index order, as a scalar subquery (no driver round trip)."""
    ordered = mapping.select(F.sort_array(F.collect_list(F.struct("idx", "label"))).alias("a"))
    return ordered.select(F.transform("a", lambda x: x["label"])).scalar()


def label_unindex(idx: Column, labels: Column) -> Column:
    """Index → label text (``IndexToString``): ``labels[idx]``."""
    return F.element_at(labels, idx.cast("int") + 1)


def categorical_columns(df: DataFrame, cols: Sequence[str], max_categories: int = 2) -> DataFrame:
    """``(feature, n_distinct, categorical)``: a feature is categorical when it has at
    most ``max_categories`` distinct values (the rule VectorIndexer applies).

    ``n_distinct`` is null where a feature has more.  The test takes
    ``max_categories`` + 1 aggregates over all features at once, each finding the
    smallest value above the one before: a task sends one row a round, and no
    values are shuffled.
    """
    keep = max_categories + 1
    found = {c: [] for c in cols}
    value = {c: F.col(f"`{c}`").cast("double") for c in cols}
    for _ in range(keep):
        open_ = [c for c in cols if not found[c] or found[c][-1] is not None]
        if not open_:
            break
        row = df.agg(*[F.min(F.when(value[c] > found[c][-1], value[c]) if found[c] else value[c]).alias(f"m{i}") for i, c in enumerate(open_)]).first()
        for i, c in enumerate(open_):
            found[c].append(row[f"m{i}"])
    rows = []
    for c in cols:
        n = sum(v is not None for v in found[c])
        rows.append((c, n if n <= max_categories else None, n <= max_categories))
    return df.sparkSession.createDataFrame(rows, "feature string, n_distinct long, categorical boolean")


def string_indexer(col: str = "label", out: str = "indexedLabel", order: str = "frequencyDesc") -> StringIndexer:
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType=order)


def vector_indexer(col: str = "features", out: str = "indexedFeatures", max_categories: int = 2) -> VectorIndexer:
    return VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories)


def index_to_string(labels: Sequence[str], col: str = "prediction", out: str = "predictedLabel") -> IndexToString:
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels))
