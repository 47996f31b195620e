"""Decision trees, random forests and multilayer perceptrons through MLlib.

One parametrised experiment replaces the reference's one-script-per-setting
layout: balance (none / over / under, before or after the split), a key-hash
70/30 split, fit, one scoring pass that is cached, and every metric from that
scored frame.  The driver only loops over experiment specs; each fit is a
distributed MLlib job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import key_text
from ..session import materialize, scratch_path
from . import features as FE
from . import metrics as M
from . import sampling as S


@dataclass(frozen=True)
class Spec:
    """One experiment: algorithm, balancing and model parameters."""

    algo: str  # "tree" | "forest" | "mlp"
    balance: str = "none"  # "none" | "over" | "under"
    balance_scope: str = "all"  # "all": before the split (as the reference) | "train": training part only
    num_trees: int = 10
    layers: tuple[int, ...] = ()
    seed: int = 1234
    max_iter: int = 100
    block_size: int = 128
    label_order: str = "alphabetAsc"  # keeps label 1 at index 1, so scores mean P(label = 1)


def reference_grid() -> list[Spec]:
    """The reference's 18 settings: 3 trees, 9 forests, 6 perceptrons."""
    specs = [Spec("tree", b) for b in ("none", "over", "under")]
    specs += [Spec("forest", b, num_trees=t) for t in (10, 50, 100) for b in ("none", "over", "under")]
    specs += [Spec("mlp", b, layers=l) for l in ((6, 10, 2), (6, 6, 4, 2)) for b in ("none", "over", "under")]
    return specs


def undersample_seed(seed: int) -> int:
    """Seed of the undersampling hash, distinct from the split's ``seed``."""
    return seed + 7919


def balance(df: DataFrame, spec: Spec, key: str, label: str) -> DataFrame:
    """Apply the spec's rebalancing; oversampled copies get distinct split keys."""
    if spec.balance == "none":
        return df.withColumn("_skey", F.col(key).cast("string"))
    if spec.balance == "over":
        over = S.oversample(df, label, k=2, copy_col="_copy")
        return over.withColumn("_skey", key_text([key, "_copy"])).drop("_copy")
    if spec.balance == "under":
        # A seed apart from the split's: with one hash for both, every kept
        # negative (hash < P/(P+N)) would fall on the same side of the split.
        kept = S.undersample(df, F.col(key).cast("string"), label, seed=undersample_seed(spec.seed))
        return kept.withColumn("_skey", F.col(key).cast("string"))
    raise ValueError(spec.balance)


def build_estimator(spec: Spec, n_features: int):
    if spec.algo == "tree":
        return DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", seed=spec.seed)
    if spec.algo == "forest":
        return RandomForestClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures",
                                      numTrees=spec.num_trees, seed=spec.seed)
    if spec.algo == "mlp":
        layers = list(spec.layers) or [n_features, 10, 2]
        if layers[0] != n_features:
            raise ValueError(f"first layer {layers[0]} != {n_features} features")
        return MultilayerPerceptronClassifier(labelCol="label_d", featuresCol="features", layers=layers,
                                              maxIter=spec.max_iter, blockSize=spec.block_size, seed=spec.seed)
    raise ValueError(spec.algo)


def fit(spec: Spec, balanced: DataFrame, train: DataFrame, feature_cols: Sequence[str], label: str) -> PipelineModel:
    """Fit the spec's pipeline.  As in the reference, the label and feature
    indexers are fitted on the whole (balanced) data, the classifier on ``train``."""
    pre = [] if "features" in train.columns else [
        FE.VectorAssembler(inputCols=list(feature_cols), outputCol="features")]
    if spec.algo == "mlp":
        return Pipeline(stages=[*pre, build_estimator(spec, len(feature_cols))]).fit(
            train.withColumn("label_d", F.col(label).cast("double")))
    assembled = pre[0].transform(balanced) if pre else balanced
    label_idx = FE.string_indexer(label, "indexedLabel", spec.label_order).fit(assembled)
    feat_idx = FE.vector_indexer("features", "indexedFeatures", 2).fit(assembled)
    est = build_estimator(spec, len(feature_cols))
    unindex = FE.index_to_string(label_idx.labels, "prediction", "predictedLabel")
    stages = [*pre, label_idx, feat_idx, est, unindex]
    return Pipeline(stages=stages).fit(train)


def positive_score(model: PipelineModel, spec: Spec, scored: DataFrame, positive: str = "1"):
    """Probability of the positive label, whatever index the label got."""
    prob = vector_to_array(F.col("probability"))
    if spec.algo == "mlp":
        return prob[1]
    labels = next(st for st in model.stages if hasattr(st, "labels") and hasattr(st, "getStringOrderType")).labels
    return prob[labels.index(positive)] if positive in labels else F.lit(0.0)


def score(model: PipelineModel, spec: Spec, test: DataFrame, label: str) -> DataFrame:
    """Scored test rows with ``score`` (P(label = 1)) and ``pred`` (0/1 label)."""
    scored = model.transform(test)
    pred = F.col("prediction") if spec.algo == "mlp" else F.col("predictedLabel").cast("double")
    return scored.withColumn("score", positive_score(model, spec, scored)).withColumn("pred", pred)


#: Partitions of a prepared training table: one for so many rows, and a least
#: number.  Seeded bagging depends on them, so they follow from the row count alone,
#: never from the cluster: a model is the same everywhere.
TRAIN_ROWS, TRAIN_PARTITIONS = 1_000_000, 32


def train_partitions(rows: int) -> int:
    return max(TRAIN_PARTITIONS, -(-rows // TRAIN_ROWS))


def prepare_input(df: DataFrame, feature_cols: Sequence[str], label: str, key: str,
                  partitions: int | None = None) -> DataFrame:
    """Compact, cached ``(key, features, label)`` table that experiments hash,
    split and balance without re-reading the source.

    Rows are dealt by the key's hash into a number of partitions that follows from
    their count (``train_partitions``), and sorted in each.
    """
    if partitions is None:
        partitions = train_partitions(df.select(key).count())
    compact = FE.assemble(df, feature_cols, "features").select(key, "features", label)
    out = compact.repartition(partitions, F.col(key)).sortWithinPartitions(key).cache()
    out.count()
    return out


def _parts(df: DataFrame, spec: Spec, label: str, key: str, weights: Sequence[float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The balanced rows, and their training and test parts."""
    balanced = balance(df, spec, key, label)
    if spec.balance_scope == "train" and spec.balance != "none":
        base = balance(df, Spec(spec.algo, "none", seed=spec.seed), key, label)
        train, test = S.split(base, F.col("_skey"), weights, spec.seed)
        return balanced, balance(train.drop("_skey"), spec, key, label), test
    return balanced, *S.split(balanced, F.col("_skey"), weights, spec.seed)


def predictions(df: DataFrame, spec: Spec, feature_cols: Sequence[str], label: str = "label", key: str = "id",
                weights: Sequence[float] = (0.7, 0.3)) -> DataFrame:
    """``(key, label, pred, score)`` of an experiment's test rows (a copied row of
    an oversampled test part appears as often as it was copied)."""
    data = prepare_input(df, feature_cols, label, key)
    balanced, train, test = _parts(data, spec, label, key, weights)
    model = fit(spec, balanced, train, feature_cols, label)
    out = materialize(score(model, spec, test, label).select(key, label, "pred", "score"), "predictions")
    data.unpersist()
    return out


def confusion(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """``(label, pred, n)``: how often each label got each prediction."""
    return scored.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def run_experiment(df: DataFrame, spec: Spec, feature_cols: Sequence[str], label: str = "label",
                   key: str = "id", weights: Sequence[float] = (0.7, 0.3), prepared: bool = False) -> dict:
    """One experiment → one result record (metrics computed from one cached scoring).

    ``prepared``: ``df`` already is ``prepare_input``'s output (the grid
    prepares once for all its experiments)."""
    data = df if prepared else prepare_input(df, feature_cols, label, key)
    df = data
    balanced, train, test = _parts(df, spec, label, key, weights)
    train = train.cache()
    model = fit(spec, balanced, train, feature_cols, label)
    scored = score(model, spec, test, label).select("pred", "score", F.col(label).alias("_y")).cache()
    acc = M.accuracy_and_auc_hard(scored, "pred", "_y").first()
    hard = acc
    auc = M.auc_scores(scored, "score", "_y").first()
    n_train = train.count()
    scored.unpersist()
    train.unpersist()
    if not prepared:
        data.unpersist()
    return {
        "algo": spec.algo, "balance": spec.balance, "balance_scope": spec.balance_scope,
        "num_trees": spec.num_trees if spec.algo == "forest" else None,
        "layers": list(spec.layers) if spec.algo == "mlp" else None, "seed": spec.seed,
        "accuracy": acc["accuracy"], "test_error": acc["test_error"],
        "auc_scores": auc["auc"], "auc_hard": hard["auc_hard"],
        "n_train": n_train, "n_test": acc["n"],
    }


RESULT_SCHEMA = (
    "algo string, balance string, balance_scope string, num_trees int, layers array<int>, seed int, "
    "accuracy double, test_error double, auc_scores double, auc_hard double, n_train long, n_test long"
)


def run_grid(spark: SparkSession, df: DataFrame, specs: Sequence[Spec], feature_cols: Sequence[str],
             label: str = "label", key: str = "id", concurrent: int = 4) -> DataFrame:
    """Results of several experiments side by side, as one DataFrame.

    The input is prepared once.  Experiments are independent, so up to
    ``concurrent`` of them submit their Spark jobs at the same time from
    driver threads; the scheduler interleaves their tasks, which keeps cores
    busy when single experiments are small.  Rows keep the order of ``specs``.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    base = prepare_input(df, feature_cols, label, key)

    @inheritable_thread_target
    def one(spec: Spec) -> dict:
        return run_experiment(base, spec, feature_cols, label, key, prepared=True)

    with ThreadPoolExecutor(max_workers=max(1, concurrent)) as pool:
        rows = list(pool.map(one, specs))
    base.unpersist()
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def tree_nodes(model, feature_cols: Sequence[str]) -> DataFrame:
    """``(node, feature, threshold, prediction, impurity)`` of a fitted tree, as its
    stored form has them (``feature`` and ``threshold`` are null for leaves)."""
    spark = SparkSession.active()
    path = scratch_path(spark, "tree")
    model.write().save(path)
    names = F.array(*[F.lit(c) for c in feature_cols])
    nodes = spark.read.parquet(f"{path}/data")
    inner = F.col("leftChild") >= 0
    return nodes.select(F.col("id").alias("node"), F.when(inner, F.element_at(names, F.col("split.featureIndex") + 1)).alias("feature"),
                        F.when(inner, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"), "prediction", "impurity")


def model_summary(model) -> dict:
    """Size facts of a fitted tree model or forest (what ``print(model)`` shows)."""
    trees = getattr(model, "trees", None)
    return {
        "model": type(model).__name__,
        "depth": int(max(t.depth for t in trees) if trees else model.depth),
        "num_nodes": int(model.totalNumNodes if trees else model.numNodes),
        "num_trees": int(model.getNumTrees if trees else 1),
        "num_features": int(model.numFeatures),
        "num_classes": int(model.numClasses),
        "importances": [float(x) for x in model.featureImportances.toArray()],
    }


SUMMARY_SCHEMA = ("model string, depth int, num_nodes int, num_trees int, num_features int, num_classes int, "
                  "importances array<double>")

