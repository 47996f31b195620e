import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from rainfold.operators import classify as C
from rainfold.operators import features as FE
from rainfold.plans import fixtures as X
from rainfold.operators import sampling as S
from tests.conftest import ROOT, SF_SMALL


def test_tree_experiment(spark):
    df = X.doc(spark, SF_SMALL)
    r = C.run_experiment(df, C.Spec("tree", "none"), X.DOC_FEATURES, "label", "doc_id")
    assert 0.0 <= r["accuracy"] <= 1.0 and abs(r["accuracy"] + r["test_error"] - 1.0) < 1e-12
    assert r["n_train"] + r["n_test"] == df.count()


def test_oversample_scope_train_keeps_test_clean(spark):
    df = X.doc(spark, SF_SMALL)
    spec = C.Spec("forest", "over", balance_scope="train", num_trees=5)
    r = C.run_experiment(df, spec, X.DOC_FEATURES, "label", "doc_id")
    base = C.balance(df, C.Spec("forest", "none", seed=spec.seed), "doc_id", "label")
    train, test = S.split(base, F.col("_skey"), (0.7, 0.3), spec.seed)
    positives = train.filter("label = 1").count()
    assert r["n_test"] == test.count()  # no copies in the test part
    assert r["n_train"] == train.count() + positives  # each positive twice in the training part


def test_training_partitions_follow_from_the_rows():
    assert [C.train_partitions(n) for n in (0, 10**6, 32 * 10**6, 32 * 10**6 + 1, 10**12)] == [32, 32, 32, 33, 10**6]


def test_confusion_gives_the_experiments_accuracy(spark):
    df, spec = X.doc(spark, SF_SMALL), C.Spec("forest", "under", num_trees=5)
    r = C.run_experiment(df, spec, X.DOC_FEATURES, "label", "doc_id")
    scored = C.predictions(df, spec, X.DOC_FEATURES, "label", "doc_id")
    n = {(x["label"], x["pred"]): x["n"] for x in C.confusion(scored).collect()}
    assert sum(n.values()) == r["n_test"] and abs(sum(v for k, v in n.items() if k[0] == k[1]) / r["n_test"] - r["accuracy"]) < 1e-12


def test_null_labels_raise_or_go_where_asked(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id int, label string")
    mapping = FE.label_index_table(df, "label")
    assert {(r["label"], r["idx"]) for r in mapping.collect()} == {("b", 0), ("a", 1)}
    index = lambda how: {r["id"]: r["indexedLabel"] for r in FE.apply_label_index(df, mapping, "label", handle_invalid=how).collect()}
    assert index("skip") == {1: 1.0, 2: 0.0, 3: 0.0}
    assert index("keep") == {1: 1.0, 2: 0.0, 3: 0.0, 4: 2.0}
    with pytest.raises(Exception, match="label without an index"):
        index("error")


_ANYWHERE = """
import sys
sys.path.insert(0, {root!r})
from rainfold.session import local_session
spark = local_session({cores}, shuffle_partitions={cores} * 2)
from rainfold.operators import classify as C
from rainfold.plans import fixtures as X
r = C.run_experiment(X.doc(spark, {sf!r}), C.Spec("forest", "none", num_trees=10), X.DOC_FEATURES, "label", "doc_id")
print("RESULT", round(r["auc_scores"], 9), round(r["accuracy"], 9), r["n_train"], r["n_test"])
"""


def test_same_forest_on_any_number_of_cores():
    out = []
    for cores in (2, 4):
        run = subprocess.run([sys.executable, "-c", _ANYWHERE.format(root=ROOT, cores=cores, sf=SF_SMALL)], capture_output=True, text=True, timeout=300)
        out.append([x for x in run.stdout.splitlines() if x.startswith("RESULT")])
    assert out[0] and out[0] == out[1]


def test_label_orders(spark):
    df = X.doc(spark, SF_SMALL)  # class 1 is the majority
    freq = {r["label"]: r["idx"] for r in FE.label_index_table(df, "label", "frequencyDesc").collect()}
    alpha = {r["label"]: r["idx"] for r in FE.label_index_table(df, "label", "alphabetAsc").collect()}
    assert freq["1"] == 0 and alpha["1"] == 1
    mllib = FE.string_indexer("label", "i", "frequencyDesc").fit(df).labels
    assert [k for k, _ in sorted(freq.items(), key=lambda kv: kv[1])] == mllib


def test_categorical_detection_agrees_with_vector_indexer(spark):
    df = X.doc(spark, SF_SMALL)
    ours = {r["feature"] for r in FE.categorical_columns(df, X.DOC_FEATURES, 2).collect() if r["categorical"]}
    vi = FE.vector_indexer("features", "ix", 2).fit(FE.assemble(df, X.DOC_FEATURES))
    assert {X.DOC_FEATURES[i] for i in vi.categoryMaps} == ours


def test_undersample_and_split_are_independent(spark):
    # ratio P/(P+N) = 0.25 < 0.7: if both used one hash, no negative could reach the test part
    rows = [(i, float(i % 7), float(i % 5), float(i % 3), float(i % 11), float(i % 13), float(i % 2), int(i % 4 == 0))
            for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, f double, label int")
    r = C.run_experiment(df, C.Spec("tree", "under"), list("abcdef"), "label", "id")
    assert r["auc_scores"] is not None and r["n_test"] > 0
    pos_test = 1200 // 4 * 0.3
    assert r["n_test"] > pos_test * 1.2  # the test part holds negatives too
