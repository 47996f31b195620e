"""Feature preparation, metrics and classification queries.

Metrics are checked on a fixed rule score over the documents table (no
training, so DuckDB can compute the same numbers); the trained models are
checked by row counts here and by thresholds in the tests.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash_sql
from ..operators import classify as C
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import rocsketch as K
from ..session import scratch_path
from . import fixtures as X
from . import oracle_sql as O
from .common import finish
from .registry import register


def rule_scored(spark, sf_dir):
    """Fixed score = ⌊1000 · spaces / chars⌋ / 1000; prediction = score ≥ 0.155."""
    d = X.doc(spark, sf_dir)
    score = F.floor(F.col("n_spaces") * 1000.0 / F.col("n_chars")) / 1000.0
    return d.select("doc_id", "label", score.alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.155).cast("int"))


RULE_SQL = f"""{O.DOC},
scored AS (
  SELECT doc_id, label, floor(n_spaces * 1000.0 / n_chars) / 1000.0 AS score FROM doc
),
rule AS (SELECT *, CAST(score >= 0.155 AS INTEGER) AS prediction FROM scored),
g AS (
  SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM rule GROUP BY score
),
c AS (
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
         sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
  FROM g
)"""


@register("metric_accuracy", f"""WITH {RULE_SQL}
SELECT round(avg(CAST(prediction = label AS DOUBLE)), 6) AS accuracy,
       round(1.0 - avg(CAST(prediction = label AS DOUBLE)), 6) AS test_error, count(*) AS n FROM rule""")
def metric_accuracy(spark, sf_dir):
    return finish(M.accuracy(rule_scored(spark, sf_dir), "prediction", "label"))


@register("metric_auc_hard", f"""WITH {RULE_SQL}
SELECT round((avg(CASE WHEN label = 1 THEN prediction END) + avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2, 6)
         AS auc_hard,
       round(avg(CASE WHEN label = 1 THEN prediction END), 6) AS tpr,
       round(avg(CASE WHEN label = 0 THEN 1 - prediction END), 6) AS tnr FROM rule""")
def metric_auc_hard(spark, sf_dir):
    return finish(M.auc_hard(rule_scored(spark, sf_dir), "prediction", "label"))


@register("metric_auc_scores", f"""WITH {RULE_SQL}
SELECT round(sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""")
def metric_auc_scores(spark, sf_dir):
    return finish(M.auc_scores(rule_scored(spark, sf_dir), "score", "label"))


@register("metric_roc_points", f"""WITH {RULE_SQL}
SELECT round(score, 6) AS threshold,
       CAST(p_all - (cum_pos - pos) AS BIGINT) AS tp, CAST(n_all - (cum_neg - neg) AS BIGINT) AS fp,
       round((p_all - (cum_pos - pos)) / p_all, 6) AS tpr, round((n_all - (cum_neg - neg)) / n_all, 6) AS fpr,
       round((p_all - (cum_pos - pos)) / ((p_all - (cum_pos - pos)) + (n_all - (cum_neg - neg))), 6) AS precision,
       round((p_all - (cum_pos - pos)) / p_all, 6) AS recall
FROM c""")
def metric_roc_points(spark, sf_dir):
    return finish(M.roc_points(rule_scored(spark, sf_dir), "score", "label"))


_SKETCH = f"""{RULE_SQL},
sk AS (
  SELECT CAST(floor(score * 64) + 1 AS BIGINT) AS bucket, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg, min(score) AS low, max(score) AS high
  FROM c GROUP BY 1
),
sums AS (
  SELECT *, sum(pos) OVER (ORDER BY bucket DESC) AS tp, sum(neg) OVER (ORDER BY bucket DESC) AS fp,
         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all, sum(neg) OVER (ORDER BY bucket) AS upto FROM sk
)"""


@register("metric_roc_sketch", f"""WITH {_SKETCH}
SELECT bucket, pos, neg, round(low, 6) AS low, round(high, 6) AS high, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / p_all, 6) AS tpr, round(fp / n_all, 6) AS fpr FROM sums""")
def metric_roc_sketch(spark, sf_dir):
    """ROC points of a sketch over fixed edges, merged from two halves of the rows."""
    rows = rule_scored(spark, sf_dir)
    edges = [i / 64 for i in range(65)]
    halves = [K.sketch(rows.filter(F.pmod("doc_id", F.lit(2)) == i), edges) for i in range(2)]
    return finish(K.points(K.merge(*halves)).drop("threshold"))


@register("metric_auc_sketch", f"""WITH {_SKETCH}
SELECT round(sum(pos * (upto - neg + neg / 2.0)) / max(p_all * n_all), 6) AS auc,
       round(sum(CASE WHEN low < high THEN pos * neg / 2.0 ELSE 0 END) / max(p_all * n_all), 6) AS error,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM sums""")
def metric_auc_sketch(spark, sf_dir):
    """Area and stated error of a sketch over fixed edges."""
    return finish(K.auc(K.sketch(rule_scored(spark, sf_dir), [i / 64 for i in range(65)])))


@register("metric_auc_bounded", f"""WITH {RULE_SQL}
SELECT round(sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc, true AS within, true AS small FROM c""")
def metric_auc_bounded(spark, sf_dir):
    """The exact area, next to whether a sketch with edges found for an error of
    0.01 is as near as it says and as was asked."""
    rows = rule_scored(spark, sf_dir)
    near = K.auc(K.sketch(rows, K.bounds(rows, 0.01))).select(F.struct("auc", "error").alias("near"))
    exact = M.auc_scores(rows, "score", "label").withColumn("near", near.scalar())
    return finish(exact.select("auc", (F.abs(F.col("auc") - F.col("near.auc")) <= F.col("near.error") + 1e-12).alias("within"), (F.col("near.error") <= 0.01).alias("small")))


_F = ", ".join(f'round("{c}", 6) AS f{i}' for i, c in enumerate(X.LBL_FEATURES))


@register("assemble_features", f"WITH {O.LBL} SELECT hkey, {_F}, label FROM lbl")
def assemble_features(spark, sf_dir):
    """Six columns → one vector (shown again as columns for the check)."""
    v = FE.assemble(X.lbl(spark, sf_dir), X.LBL_FEATURES, "features")
    arr = vector_to_array(F.col("features"))
    return finish(v.select("hkey", *[arr[i].alias(f"f{i}") for i in range(len(X.LBL_FEATURES))], "label"))


LABEL_MAP_SQL = f"""{O.DOC},
lc AS (SELECT CAST(label AS VARCHAR) AS label, count(*) AS n FROM doc GROUP BY 1),
lm AS (SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label ASC) - 1 AS BIGINT) AS idx FROM lc)"""


@register("label_index", f"WITH {LABEL_MAP_SQL} SELECT label, n, idx FROM lm")
def label_index(spark, sf_dir):
    """Labels indexed by descending frequency (the majority class gets 0)."""
    return FE.label_index_table(X.doc(spark, sf_dir), "label", "frequencyDesc")


@register("label_unindex", f"""WITH {LABEL_MAP_SQL}
SELECT d.doc_id, d.label, CAST(lm.idx AS DOUBLE) AS "indexedLabel", lm.label AS label_text
FROM doc d JOIN lm ON CAST(d.label AS VARCHAR) = lm.label""")
def label_unindex(spark, sf_dir):
    """Index every row, then map the index back to label text."""
    d = X.doc(spark, sf_dir).select("doc_id", "label")
    mapping = FE.label_index_table(d, "label", "frequencyDesc")
    indexed = FE.apply_label_index(d, mapping, "label", "indexedLabel")
    return indexed.withColumn("label_text", FE.label_unindex(F.col("indexedLabel"), FE.labels_array(mapping)))


_CAT = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CASE WHEN count(DISTINCT {c}) <= 2 THEN count(DISTINCT {c}) END AS n_distinct, "
    f"count(DISTINCT {c}) <= 2 AS categorical FROM doc"
    for c in X.DOC_FEATURES)


@register("categorical_features", f"WITH {O.DOC} {_CAT}")
def categorical_features(spark, sf_dir):
    """Which features VectorIndexer(maxCategories=2) would treat as categorical."""
    return FE.categorical_columns(X.doc(spark, sf_dir), X.DOC_FEATURES, 2)


def _one(spark, sf_dir, spec):
    return spark.createDataFrame([C.run_experiment(X.doc(spark, sf_dir), spec, X.DOC_FEATURES, "label", "doc_id")],
                                 C.RESULT_SCHEMA)


def _checked(results):
    """What SQL can say of results: the settings, the sizes of both parts, and
    that the metrics are numbers in their range (NULL where the test part lacks
    a class).  The metrics themselves have thresholds in the tests."""
    within = lambda c: F.coalesce(F.col(c).between(0, 1), F.lit(True))
    sound = within("accuracy") & within("auc_scores") & within("auc_hard") & (F.abs(F.col("accuracy") + F.col("test_error") - 1) < 1e-9)
    return results.select("algo", "balance", "balance_scope", "num_trees", F.concat_ws(",", F.col("layers").cast("array<string>")).alias("layers"),
                          "seed", "n_train", "n_test", sound.alias("sound"))


def _results_sql(specs):
    """The rows of ``_checked`` for several settings: parts by the key hash."""
    rows = ", ".join(f"('{s.algo}', '{s.balance}', '{s.balance_scope}', {s.num_trees if s.algo == 'forest' else 'NULL'}, "
                     f"'{','.join(map(str, s.layers)) if s.algo == 'mlp' else ''}', {s.seed})" for s in specs)
    key = "CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)"
    seeds = {s.seed for s in specs}
    assert len(seeds) == 1
    seed = seeds.pop()
    return f"""WITH {O.DOC},
rate AS (SELECT avg(CAST(label = 1 AS DOUBLE)) AS r FROM doc),
bal AS (
  SELECT 'none' AS balance, CAST(doc_id AS VARCHAR) AS skey FROM doc
  UNION ALL SELECT 'over', {key} FROM doc, range(1, 3) t(copy) WHERE copy = 1 OR label = 1
  UNION ALL SELECT 'under', CAST(doc_id AS VARCHAR) FROM doc, rate WHERE label = 1 OR {unit_hash_sql('CAST(doc_id AS VARCHAR)', C.undersample_seed(seed))} < r
),
parts AS (
  SELECT balance, count(*) FILTER (WHERE {unit_hash_sql('skey', seed)} < 0.7) AS n_train,
         count(*) FILTER (WHERE {unit_hash_sql('skey', seed)} >= 0.7) AS n_test FROM bal GROUP BY balance
),
specs(algo, balance, balance_scope, num_trees, layers, seed) AS (VALUES {rows})
SELECT algo, balance, balance_scope, CAST(num_trees AS INTEGER) AS num_trees, layers, CAST(seed AS INTEGER) AS seed, n_train, n_test, true AS sound
FROM specs JOIN parts USING (balance)"""


TREE, FOREST = C.Spec("tree", "none"), C.Spec("forest", "under", num_trees=10)
MLP = C.Spec("mlp", "over", layers=(6, 10, 2))


def forest_metrics(spark, sf_dir):
    """One row with all metrics of the undersampled forest."""
    return _one(spark, sf_dir, FOREST)


@register("train_tree", _results_sql([TREE]))
def train_tree(spark, sf_dir):
    """Decision tree with default parameters on the unbalanced documents."""
    return _checked(_one(spark, sf_dir, TREE))


@register("train_forest", _results_sql([FOREST]))
def train_forest(spark, sf_dir):
    """Random forest, 10 trees, undersampled."""
    return _checked(_one(spark, sf_dir, FOREST))


@register("train_mlp", _results_sql([MLP]))
def train_mlp(spark, sf_dir):
    """Multilayer perceptron [6, 10, 2], oversampled, 100 iterations, block 128."""
    return _checked(_one(spark, sf_dir, MLP))


_RULE = "CAST(l_discount >= 0.05 AND \"PSSM_central_-1_S\" < 0.04 AS INTEGER)"
_RULE_SQL = f"""{O.LBL},
ruled AS (SELECT hkey, {_RULE} AS label FROM lbl),
parts AS (SELECT *, {unit_hash_sql('hkey', TREE.seed)} >= 0.7 AS test FROM ruled)"""


@register("tree_predictions", f"WITH {_RULE_SQL} SELECT hkey, label, CAST(label AS DOUBLE) AS pred FROM parts WHERE test")
def tree_predictions(spark, sf_dir):
    """Predictions of every test row by a tree whose training rows' label follows a
    rule of two splits: what the rule says of rows that it never saw."""
    return C.predictions(X.lbl_rule(spark, sf_dir), TREE, X.LBL_FEATURES, "label", "hkey").select("hkey", "label", "pred")


_OVER_SQL = f"""{O.LBL},
ruled AS (SELECT hkey, {_RULE} AS label FROM lbl),
copies AS (SELECT label, hkey || ':' || CAST(copy AS VARCHAR) AS skey FROM ruled, range(1, 3) t(copy) WHERE copy = 1 OR label = 1)"""


@register("tree_confusion_over", f"WITH {_OVER_SQL} SELECT label, label AS pred, count(*) AS n FROM copies WHERE {unit_hash_sql('skey', TREE.seed)} >= 0.7 GROUP BY label")
def tree_confusion_over(spark, sf_dir):
    """Confusion counts of the same rule after oversampling: copies of a row fall
    on either side of the split."""
    spec = C.Spec("tree", "over")
    return C.confusion(C.predictions(X.lbl_rule(spark, sf_dir), spec, X.LBL_FEATURES, "label", "hkey"))


def _between(column: str, cut: float) -> str:
    """The middle of the two neighbouring values that a threshold parts, in thousandths."""
    return f"CAST(round(500 * (max({column}) FILTER ({column} < {cut}) + min({column}) FILTER ({column} >= {cut}))) AS INTEGER)"


@register("tree_rules", f"""WITH {O.LBL}
SELECT 'split' AS kind, 'l_discount' AS feature, {_between('l_discount', 0.05)} AS n FROM lbl
UNION ALL SELECT 'split', 'PSSM_central_-1_S', {_between('"PSSM_central_-1_S"', 0.04)} FROM lbl
UNION ALL SELECT 'leaves', '', 3""")
def tree_rules(spark, sf_dir):
    """The splits of the fitted tree, thresholds in thousandths, and its leaves."""
    df = C.prepare_input(X.lbl_rule(spark, sf_dir), X.LBL_FEATURES, "label", "hkey")
    model = C.fit(TREE, df, df, X.LBL_FEATURES, "label")
    nodes = C.tree_nodes(model.stages[-2], X.LBL_FEATURES)
    splits = nodes.filter("feature IS NOT NULL").select(F.lit("split").alias("kind"), "feature", F.round(F.col("threshold") * 1000).cast("int").alias("n"))
    leaves = nodes.filter("feature IS NULL").agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit("leaves").alias("kind"), F.lit("").alias("feature"), "n")
    df.unpersist()
    return splits.unionByName(leaves)


def _fit_forest(spark, sf_dir):
    df = X.doc(spark, sf_dir)
    spec = C.Spec("forest", "none", num_trees=10)
    bal = C.balance(df, spec, "doc_id", "label")
    return df, spec, C.fit(spec, bal, bal, X.DOC_FEATURES, "label")


@register("model_summary", f"""WITH {O.DOC}
SELECT 10 AS num_trees, {len(X.DOC_FEATURES)} AS num_features, CAST(count(DISTINCT label) AS INTEGER) AS num_classes, true AS sound FROM doc""")
def model_summary(spark, sf_dir):
    """Size facts of a 10-tree forest (depth, nodes, trees, features, classes, importances)."""
    _, _, model = _fit_forest(spark, sf_dir)
    out = spark.createDataFrame([C.model_summary(model.stages[3])], C.SUMMARY_SCHEMA)
    total = F.aggregate("importances", F.lit(0.0), lambda a, x: a + x)
    sound = F.col("depth").between(1, 5) & (F.col("num_nodes") >= 3 * F.col("num_trees")) & (F.abs(total - 1) < 1e-6)
    return out.select("num_trees", "num_features", "num_classes", sound.alias("sound"))


@register("model_roundtrip", f"WITH {O.DOC} SELECT doc_id, true AS same FROM doc")
def model_roundtrip(spark, sf_dir):
    """Save the fitted pipeline, load it back, and score with both: predictions agree."""
    df, spec, model = _fit_forest(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = model.transform(df).select("doc_id", F.col("prediction").alias("p_fitted"))
    b = loaded.transform(df).select("doc_id", F.col("prediction").alias("p_loaded"))
    return a.join(b, "doc_id").select("doc_id", (F.col("p_fitted") == F.col("p_loaded")).alias("same"))


@register("preview_predictions", f"""WITH {O.DOC}
SELECT doc_id, label, {', '.join(f'round({c}, 6) AS f{i}' for i, c in enumerate(X.DOC_FEATURES))}, true AS known FROM doc ORDER BY doc_id LIMIT 5""")
def preview_predictions(spark, sf_dir):
    """The first five scored rows by document id (the reference's ``show(5)``)."""
    df, spec, model = _fit_forest(spark, sf_dir)
    out = model.transform(df).select("doc_id", "predictedLabel", "label",
                                     vector_to_array("features").alias("features"))
    known = F.col("predictedLabel").isin("0", "1").alias("known")
    columns = [F.col("features")[i].alias(f"f{i}") for i in range(len(X.DOC_FEATURES))]
    return finish(out.orderBy("doc_id").limit(5).select("doc_id", "label", *columns, known))


@register("experiment_grid", _results_sql(C.reference_grid()))
def experiment_grid(spark, sf_dir):
    """All 18 reference settings (3 trees, 9 forests, 6 perceptrons) side by side."""
    return _checked(C.run_grid(spark, X.doc(spark, sf_dir), C.reference_grid(), X.DOC_FEATURES, "label", "doc_id"))
