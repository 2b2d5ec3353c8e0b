"""Models (§2.12), evaluation (§2.13), model tables (§2.8) and report sinks.

Evaluation keys run on the test split scored by two stored scorers with fixed values, a
linear one and boosted trees as a node table, so each has an exact DuckDB oracle. Keys of
MLlib fits return the fits' own numbers, which no SQL can give; what holds of every fit, whatever its
numbers, is stated by the ``*_facts`` keys and their SQL.
"""

from __future__ import annotations

import re
import threading

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import prob_pos as _prob_pos
from ..operators import clean as K
from ..operators import encoding as EN
from ..operators import ensembles as ENS
from ..operators import evaluation as EV
from ..operators import models as M
from ..operators import sampling as SM
from ..operators.features import CATEGORICAL, FEATURE_COLS
from ..operators.learning import learning_curve as _learning_curve
from ..session import scratch_path
from ..sources.campaigns import snapshot
from ..sources import files as IO
from .oracle import FEATURES_CTE, VALIDATED_CTE, hash_unit_sql, index_sql, with_campaigns
from .q_clean import model_table
from .registry import register

SEED = 42
TRAIN = 0.8
FOLDS = 2
BINARY = (0.0, 1.0)

# Stored logistic coefficients of the linear scorer (an LR fit
# on goal_log, duration in seconds and staff_pick), and its intercept.
LINEAR_COEFFICIENTS = {"goal_log": -2.27, "duration": 4.93e-09, "staff_pick": -0.05}
LINEAR_INTERCEPT = 27.16


def _d(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


_lin = _d(LINEAR_INTERCEPT)
for _c, _w in LINEAR_COEFFICIENTS.items():
    _lin = f"({_lin} + ({_d(_w)} * CAST({_c} AS DOUBLE)))"

SCORED_CTE = VALIDATED_CTE + ",\n" + FEATURES_CTE + f""",
scored AS (
  SELECT id, label, score, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM (
    SELECT id, state AS label, (1.0 / (1.0 + exp(-{_lin}))) AS score
    FROM features WHERE {hash_unit_sql('id', SEED)} >= {SM.threshold(TRAIN)}) s),
sc AS (
  SELECT score, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM scored WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
asc_cum AS (
  SELECT score, pos, neg, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
  FROM sc),
desc_cum AS (
  SELECT score, pos, neg,
         SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
         SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
         SUM(pos) OVER () AS tot_pos, SUM(neg) OVER () AS tot_neg
  FROM sc),
cm AS (
  SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, COUNT(*) AS n
  FROM scored GROUP BY 1, 2),
cls AS (
  SELECT COALESCE(a.c, b.c) AS c, COALESCE(a.support, 0) AS support, COALESCE(a.tp, 0) AS tp,
         COALESCE(b.predicted, 0) AS predicted
  FROM (SELECT label AS c, SUM(n) AS support, SUM(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
        FROM cm GROUP BY label) a
  FULL OUTER JOIN (SELECT prediction AS c, SUM(n) AS predicted FROM cm GROUP BY prediction) b ON a.c = b.c),
cls2 AS (
  SELECT c, support, COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(predicted AS DOUBLE), 0), 0.0) AS precision,
         COALESCE(CAST(tp AS DOUBLE) / NULLIF(CAST(support AS DOUBLE), 0), 0.0) AS recall FROM cls),
cls3 AS (
  SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM cls2)"""

AUC_SQL = ("SELECT ROUND(SUM(CAST(pos AS DOUBLE) * (CAST(cum_neg - neg AS DOUBLE) + CAST(neg AS DOUBLE) / 2)) / "
           "(CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 6) AS auc FROM asc_cum")
ACC_SQL = "SELECT ROUND(AVG(CASE WHEN CAST(label AS DOUBLE) = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored"
W_SQL = "SELECT ROUND(SUM(CAST(support AS DOUBLE) * {m}) / SUM(CAST(support AS DOUBLE)), 6) AS {m} FROM cls3"
AP_SQL = ("SELECT ROUND(SUM((CAST(pos AS DOUBLE) / CAST(tot_pos AS DOUBLE)) * "
          "(CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE))), 6) AS average_precision FROM desc_cum")
PR_RATE_SQL = "SELECT ROUND(AVG(CAST(label AS DOUBLE)), 6) AS positive_rate FROM scored"

_cache: dict = {}
_locks: dict = {}
_guard = threading.Lock()


def _memo(spark, sf, name, fn):
    """Fit (or prepare) once per application, even under concurrent callers."""
    key, source = (spark.sparkContext.applicationId, sf, name), snapshot(spark, sf)
    with _guard:
        lock = _locks.setdefault(key, threading.Lock())
    with lock:
        if key not in _cache or _cache[key][0] != source:
            old = _cache.pop(key, (None, None))[1]
            if hasattr(old, "unpersist"):  # of sources that have changed since
                old.unpersist()
            _cache[key] = (source, fn())
    return _cache[key][1]


def release(spark):
    """Forget this application's fits and prepared tables."""
    with _guard:
        for key in [k for k in _cache if k[0] == spark.sparkContext.applicationId]:
            held = _cache.pop(key)[1]
            if hasattr(held, "unpersist"):
                held.unpersist()


def linear_scored(spark, sf):
    """Test split scored by the stored linear coefficients: id, label, score, prediction."""
    feats = K.with_features(K.validate(model_table(spark, sf)))
    test = feats.filter(~SM.in_fraction(TRAIN, "id", SEED))
    out = M.score_linear(test, LINEAR_COEFFICIENTS, LINEAR_INTERCEPT)
    return out.select("id", F.col("state").alias("label"), "score", "prediction")


@register("score_linear", with_campaigns(
    "SELECT id, label, ROUND(score, 6) AS score, prediction FROM scored", SCORED_CTE), "models")
def score_linear(spark, sf):
    return linear_scored(spark, sf).withColumn("score", F.round("score", 6))


# Stored boosted trees on the model's features, in the columns of a node table
# (category codes by frequency).
STORED_NODES = [
    (0, 0, "goal_log", 12.18, None, None, 1, 2, None, 1200, 0.42, False),
    (0, 1, "category_index", None, [0.0, 2.0, 5.0, 9.0], 15, 3, 4, None, 450, 0.06, False),
    (0, 2, "duration", 9979200.0, None, None, 5, 6, None, 750, 0.03, False),
    (0, 3, None, None, None, None, None, None, 0.71, 250, None, False),
    (0, 4, None, None, None, None, None, None, 0.28, 200, None, False),
    (0, 5, None, None, None, None, None, None, -0.33, 300, None, False),
    (0, 6, None, None, None, None, None, None, -0.64, 450, None, False),
    (1, 0, "country_index", None, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0], 25, 1, 2, None, 1200, 0.02, False),
    (1, 1, "staff_pick", 0.5, None, None, 3, 4, None, 700, 0.01, False),
    (1, 2, None, None, None, None, None, None, -0.041, 500, None, False),
    (1, 3, None, None, None, None, None, None, 0.023, 400, None, False),
    (1, 4, None, None, None, None, None, None, 0.057, 300, None, False),
    (2, 0, "goal_log", 11.4, None, None, 1, 2, None, 1200, 0.11, False),
    (2, 1, None, None, None, None, None, None, 0.052, 220, None, False),
    (2, 2, "goal_log", 12.6, None, None, 3, 4, None, 980, 0.04, False),
    (2, 3, None, None, None, None, None, None, 0.006, 410, None, False),
    (2, 4, None, None, None, None, None, None, -0.044, 570, None, False),
]


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, list):
        return "[" + ", ".join(map(_d, v)) + "]"
    return f"'{v}'" if isinstance(v, str) else _d(v) if isinstance(v, float) else str(v).upper()


def _walk_sql(at: str) -> str:
    """The node after node ``at`` of a row x."""
    v = "CASE " + " ".join(f"WHEN {at}.feature = '{f}' THEN x.{f}" for f in FEATURE_COLS) + " END"
    left = (f"CASE WHEN {at}.categories IS NULL THEN {v} <= {at}.threshold WHEN len({at}.categories) <= {at}.n_categories // 2 "
            f"THEN list_contains({at}.categories, {v}) ELSE list_contains({at}.categories, {v}) OR {v} >= {at}.n_categories END")
    return f"CASE WHEN {at}.l IS NULL THEN {at}.node WHEN {left} THEN {at}.l ELSE {at}.r END"


NODES_CTE = """nodes(tree, node, feature, threshold, categories, n_categories, l, r, value, n, gain, votes) AS (VALUES
  """ + ",\n  ".join("(" + ", ".join(map(_sql_value, row)) + ")" for row in STORED_NODES) + ")"
# The trees are at most two splits deep.
STORED_CTE = f"""{NODES_CTE},
cat_idx AS ({index_sql('category', 'features')}),
ctr_idx AS ({index_sql('country', 'features')}),
x AS (
  SELECT f.id, f.state AS label, f.goal_log, CAST(f.duration AS DOUBLE) AS duration, CAST(f.staff_pick AS DOUBLE) AS staff_pick,
         a.idx AS category_index, b.idx AS country_index
  FROM features f JOIN cat_idx a ON f.category = a.v JOIN ctr_idx b ON f.country = b.v
  WHERE f.duration IS NOT NULL AND f.staff_pick IS NOT NULL),
one AS (SELECT x.*, n.tree, {_walk_sql('n')} AS node FROM x, nodes n WHERE n.node = 0),
two AS (SELECT x.* EXCLUDE (node), {_walk_sql('n')} AS node FROM one x JOIN nodes n ON n.tree = x.tree AND n.node = x.node),
boosted AS (
  SELECT id, label, score, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM (
    SELECT x.id, any_value(x.label) AS label, 1.0 / (1.0 + exp(-2.0 * sum(n.value ORDER BY n.tree))) AS score
    FROM two x JOIN nodes n ON n.tree = x.tree AND n.node = x.node GROUP BY x.id) b)"""


def stored_ensemble(spark):
    """The node table of the stored boosted trees, written and read as any model's."""
    path = IO.write_parquet(spark.createDataFrame(STORED_NODES, ENS.NODE_SCHEMA), scratch_path(spark, "stored_trees"))
    return spark.read.parquet(path)


def _stored_features(spark, sf):
    """The columns that the stored trees split by."""
    rows = M.prepare(K.validate(model_table(spark, sf))).withColumn("goal_log", F.log1p("goal"))
    return EN.encode(rows, CATEGORICAL)


def boosted_scored(spark, sf, test_only: bool = False):
    """Prepared rows scored by the stored boosted trees: id, label, score, prediction."""
    out = ENS.score_table(_stored_features(spark, sf), stored_ensemble(spark))
    if test_only:
        out = out.filter(~SM.in_fraction(TRAIN, "id", SEED))
    return out.select("id", F.col(M.LABEL).alias("label"), "score", "prediction")


@register("eval_auc", with_campaigns(AUC_SQL, SCORED_CTE), "evaluation")
def eval_auc(spark, sf):
    return EV.auc(linear_scored(spark, sf))


@register("eval_accuracy", with_campaigns(ACC_SQL, SCORED_CTE), "evaluation")
def eval_accuracy(spark, sf):
    return EV.accuracy(linear_scored(spark, sf))


@register("eval_f1", with_campaigns(W_SQL.format(m="f1"), SCORED_CTE), "evaluation")
def eval_f1(spark, sf):
    return EV.weighted_metrics(linear_scored(spark, sf), classes=BINARY).select("f1")


@register("eval_precision", with_campaigns(W_SQL.format(m="precision"), SCORED_CTE), "evaluation")
def eval_precision(spark, sf):
    return EV.weighted_metrics(linear_scored(spark, sf), classes=BINARY).select("precision")


@register("eval_recall", with_campaigns(W_SQL.format(m="recall"), SCORED_CTE), "evaluation")
def eval_recall(spark, sf):
    return EV.weighted_metrics(linear_scored(spark, sf), classes=BINARY).select("recall")


@register("confusion_matrix", with_campaigns("""
SELECT g.label, g.prediction, CAST(COALESCE(cm.n, 0) AS BIGINT) AS n
FROM (SELECT * FROM (VALUES (0.0::DOUBLE, 0.0::DOUBLE), (0.0::DOUBLE, 1.0::DOUBLE), (1.0::DOUBLE, 0.0::DOUBLE),
                            (1.0::DOUBLE, 1.0::DOUBLE)) AS t(label, prediction)) g
LEFT JOIN cm ON cm.label = g.label AND cm.prediction = g.prediction""", SCORED_CTE), "evaluation")
def confusion_matrix(spark, sf):
    return EV.confusion_matrix(linear_scored(spark, sf))


@register("roc_points", with_campaigns("""
SELECT ROUND(score, 6) AS threshold, ROUND(CAST(cum_neg AS DOUBLE) / CAST(tot_neg AS DOUBLE), 6) AS fpr,
       ROUND(CAST(cum_pos AS DOUBLE) / CAST(tot_pos AS DOUBLE), 6) AS tpr FROM desc_cum""", SCORED_CTE), "evaluation")
def roc_points(spark, sf):
    return EV.roc_points(linear_scored(spark, sf))


@register("pr_points", with_campaigns("""
SELECT ROUND(score, 6) AS threshold, ROUND(CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE), 6) AS precision,
       ROUND(CAST(cum_pos AS DOUBLE) / CAST(tot_pos AS DOUBLE), 6) AS recall FROM desc_cum""", SCORED_CTE), "evaluation")
def pr_points(spark, sf):
    return EV.pr_points(linear_scored(spark, sf))


@register("average_precision", with_campaigns(AP_SQL, SCORED_CTE), "evaluation")
def average_precision(spark, sf):
    return EV.average_precision(linear_scored(spark, sf))


@register("positive_rate", with_campaigns(PR_RATE_SQL, SCORED_CTE), "evaluation")
def positive_rate(spark, sf):
    return EV.positive_rate(linear_scored(spark, sf))


METRICS_SCHEMA = T.StructType([T.StructField(n, T.DoubleType()) for n in
                               ["auc", "accuracy", "f1", "precision", "recall"]])


@register("report_json_sink", with_campaigns(f"""
SELECT a.auc, b.accuracy, c.f1, d.precision, e.recall
FROM ({AUC_SQL}) a, ({ACC_SQL}) b, ({W_SQL.format(m='f1')}) c, ({W_SQL.format(m='precision')}) d,
     ({W_SQL.format(m='recall')}) e""", SCORED_CTE), "io")
def report_json_sink(spark, sf):
    row = EV.metric_row(linear_scored(spark, sf), "linear").drop("model")
    path = IO.write_json(row.coalesce(1), scratch_path(spark, "report"))
    return IO.read_json(spark, path, METRICS_SCHEMA)


# ---- MLlib models (rows-only checks) ------------------------------------------------

def prepared(spark, sf):
    """Model table with split and fold columns, persisted for iterative fits."""
    def build():
        df = M.prepare(K.validate(model_table(spark, sf)))
        df = SM.kfold(SM.with_split(df, "id", TRAIN, SEED), FOLDS, "id", SEED)
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return _memo(spark, sf, "prepared", build)


def train_test(spark, sf):
    df = prepared(spark, sf)
    return df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")


def fitted(spark, sf, name):
    def build():
        train, _ = train_test(spark, sf)
        if name == "LR":
            return M.fit_lr(train)
        if name == "RF":
            return M.fit_rf(train)
        if name == "DT":
            return M.fit_dt(train)
        if name == "GBT":
            return M.fit_gbt_cv(train, num_folds=FOLDS)
        raise KeyError(name)
    return _memo(spark, sf, name, build)


def _test_scores(spark, sf, name):
    _, test = train_test(spark, sf)
    return M.score_model(fitted(spark, sf, name)[0], test)


PREPARED_CTE = VALIDATED_CTE + ",\n" + FEATURES_CTE + """,
prepared AS (SELECT id, state AS label FROM features
             WHERE duration IS NOT NULL AND staff_pick IS NOT NULL)"""
IS_TEST = f"{hash_unit_sql('id', SEED)} >= {SM.threshold(TRAIN)}"
SAME_SQL = with_campaigns(f"SELECT id, label, TRUE AS same_score FROM prepared WHERE {IS_TEST}", PREPARED_CTE)
IS_PROBABILITY = "coalesce(score >= 0 and score <= 1, false)"
FITTED = ("LR", "RF", "DT", "GBT")


@register("fit_lr", None, "models")
def fit_lr(spark, sf):
    return _test_scores(spark, sf, "LR")


@register("fit_rf", None, "models")
def fit_rf(spark, sf):
    return _test_scores(spark, sf, "RF")


@register("fit_dt", None, "models")
def fit_dt(spark, sf):
    return _test_scores(spark, sf, "DT")


@register("fit_gbt_cv", None, "models")
def fit_gbt_cv(spark, sf):
    return _test_scores(spark, sf, "GBT")


_MODELS = ", ".join(f"('{n}')" for n in FITTED)


@register("fit_facts", with_campaigns(
    f"SELECT model, id, label, TRUE AS is_probability, TRUE AS auc_above_half FROM prepared, (VALUES {_MODELS}) AS m(model) WHERE {IS_TEST}",
    PREPARED_CTE), "models")
def fit_facts(spark, sf):
    """Of each fit: which rows it scores, that scores are probabilities and better than chance."""
    scored = IO.written(_all_test_scores(spark, sf), "test_scores")
    better = EV.auc(scored, group_cols=["model"]).select("model", (F.col("auc") > 0.5).alias("auc_above_half"))
    return scored.join(better, "model").select("model", "id", "label", F.expr(IS_PROBABILITY).alias("is_probability"), "auc_above_half")


_GRID = [(d, i) for d in M.GBT_DEPTHS for i in M.GBT_ITERS]


@register("cv_results", None, "models")
def cv_results(spark, sf):
    return M.cv_results(fitted(spark, sf, "GBT")[0])


@register("cv_facts", "SELECT * FROM (VALUES " + ", ".join(
    f"({d}, {i}, TRUE, 1)" for d, i in _GRID) + ') AS t("maxDepth", "maxIter", is_auc, n_best)', "models")
def cv_facts(spark, sf):
    found = M.cv_results(fitted(spark, sf, "GBT")[0])
    # The best row is the one of the highest mean, and the only one so marked: a row for each combination.
    best = found.filter("is_best").select(F.col("avg_auc").alias("top"))
    facts = found.agg(F.count_if("is_best").cast("int").alias("n"), F.max("avg_auc").alias("m")).first()
    right = best.first()["top"] == facts["m"]
    return found.select("maxDepth", "maxIter", F.expr("avg_auc > 0.5 and avg_auc <= 1").alias("is_auc"),
                        F.lit(facts["n"] if right else 0).cast("int").alias("n_best"))


_gini = lambda c, p: f"(1 - ({p} / {c}) * ({p} / {c}) - (1 - {p} / {c}) * (1 - {p} / {c}))"
_part = lambda k: f"COALESCE({k}.c / n.c * {_gini(f'{k}.c', f'{k}.p')}, 0)"


@register("feature_importance", with_campaigns(f"""
SELECT feature, importance, CAST(ROW_NUMBER() OVER (ORDER BY importance DESC, place) AS INTEGER) AS rank FROM (
  SELECT f.feature, f.place, ROUND(COALESCE(g.g, 0) / (SELECT sum(g) FROM gains), 6) AS importance
  FROM (VALUES {', '.join(f"('{f}', {i})" for i, f in enumerate(FEATURE_COLS))}) AS f(feature, place)
  LEFT JOIN gains g ON g.feature = f.feature) s""", VALIDATED_CTE + ",\n" + FEATURES_CTE + ",\n" + STORED_CTE + f""",
passed AS (SELECT id, label, tree, 0 AS node FROM one UNION SELECT id, label, tree, node FROM one
           UNION SELECT id, label, tree, node FROM two),
counted AS (SELECT tree, node, CAST(count(*) AS DOUBLE) AS c, CAST(sum(label) AS DOUBLE) AS p FROM passed GROUP BY tree, node),
gains AS (
  SELECT m.feature, sum(n.c * ({_gini('n.c', 'n.p')} - {_part('a')} - {_part('b')})) AS g
  FROM nodes m JOIN counted n ON n.tree = m.tree AND n.node = m.node
  LEFT JOIN counted a ON a.tree = m.tree AND a.node = m.l LEFT JOIN counted b ON b.tree = m.tree AND b.node = m.r
  WHERE m.l IS NOT NULL GROUP BY m.feature)"""), "models")
def feature_importance(spark, sf):
    """Of the stored boosted trees over all prepared rows: what their splits separate there."""
    rows = _stored_features(spark, sf)
    return ENS.importances(ENS.on_rows(rows, stored_ensemble(spark), M.LABEL))


def _fitted_importance(spark, sf):
    out = None
    for n in ("RF", "DT", "GBT"):
        own = ENS.importances(ENS.node_table(fitted(spark, sf, n)[0])).withColumn("model", F.lit(n))
        out = own if out is None else out.unionByName(own)
    return out.select("model", "feature", "importance", "rank")


@register("feature_importance_fitted", None, "models")
def feature_importance_fitted(spark, sf):
    return _fitted_importance(spark, sf)


@register("importance_facts", "SELECT model, CAST(rank AS INTEGER) AS rank, TRUE AS in_order, TRUE AS sums_to_one "
          "FROM (VALUES ('RF'), ('DT'), ('GBT')) AS m(model), "
          f"(SELECT unnest(range(1, {len(FEATURE_COLS) + 1})) AS rank) r", "models")
def importance_facts(spark, sf):
    found = _fitted_importance(spark, sf)
    own = Window.partitionBy("model")
    before = F.lag("importance").over(own.orderBy("rank"))
    return found.select("model", "rank", F.coalesce(before >= F.col("importance"), F.lit(True)).alias("in_order"),
                        (F.abs(F.sum("importance").over(own) - 1) < 1e-4).alias("sums_to_one"))


@register("export_lr_coefficients", with_campaigns(
    f"SELECT id, TRUE AS agrees FROM prepared WHERE {IS_TEST}", PREPARED_CTE), "models")
def export_lr_coefficients(spark, sf):
    """The written coefficients, put back into the linear scorer, score as the model does."""
    model = fitted(spark, sf, "LR")[0]
    path = IO.write_parquet(M.lr_coefficients(model), scratch_path(spark, "lr_coefficients"))
    terms = {r["term"]: r["value"] for r in spark.read.parquet(path).collect()}  # a row for each feature
    intercept = terms.pop("intercept")
    _, test = train_test(spark, sf)
    indexed = PipelineModel(model.stages[:-1]).transform(test)
    linear = M.score_linear(indexed, terms, intercept, "linear").select("id", "linear")
    return linear.join(_test_scores(spark, sf, "LR"), "id").select(
        "id", (F.abs(F.col("linear") - F.col("score")) < 1e-9).alias("agrees"))


@register("score_model", with_campaigns("SELECT id, label, prediction, ROUND(score, 6) AS score FROM boosted",
                                       VALIDATED_CTE + ",\n" + FEATURES_CTE + ",\n" + STORED_CTE), "models")
def score_model(spark, sf):
    """All prepared rows scored by the stored boosted trees."""
    return boosted_scored(spark, sf).select("id", "label", "prediction", F.round("score", 6).alias("score"))


@register("prob_pos", with_campaigns("SELECT id, ROUND(score, 6) AS score FROM boosted",
                                    VALIDATED_CTE + ",\n" + FEATURES_CTE + ",\n" + STORED_CTE), "scalar")
def prob_pos(spark, sf):
    """The positive class's element of a probability vector, as classifiers return it."""
    vector = array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    return boosted_scored(spark, sf).withColumn("probability", vector).select(
        "id", F.round(_prob_pos("probability"), 6).alias("score"))


def _same_as_direct(spark, sf, scored):
    direct = _test_scores(spark, sf, "LR").select("id", F.col("score").alias("direct"))
    return scored.join(direct, "id").select("id", "label", (F.col("score") == F.col("direct")).alias("same_score"))


@register("reuse_stage", SAME_SQL, "models")
def reuse_stage(spark, sf):
    model = fitted(spark, sf, "LR")[0]
    wrapped = M.reuse_stage(model, model.stages[-1], M.indexer_labels(model))
    _, test = train_test(spark, sf)
    return _same_as_direct(spark, sf, M.score_model(wrapped, test))


@register("model_store", SAME_SQL, "models")
def model_store(spark, sf):
    """A saved and loaded pipeline scores as the fitted one; so do the written node tables of the tree models."""
    path = M.save_model(fitted(spark, sf, "LR")[0], scratch_path(spark, "model"))
    _, test = train_test(spark, sf)
    same = _same_as_direct(spark, sf, M.score_model(M.load_pipeline(path), test))
    for name in ("RF", "DT", "GBT"):
        model = fitted(spark, sf, name)[0]
        table = spark.read.parquet(IO.write_parquet(ENS.node_table(model), scratch_path(spark, "trees")))
        indexed = PipelineModel(stages=getattr(model, "bestModel", model).stages[:-1]).transform(test)
        scored = ENS.score_table(indexed, table).select("id", F.col("score").alias("table"))
        direct = _test_scores(spark, sf, name).select("id", "score")
        agrees = scored.join(direct, "id").select("id", (F.abs(F.col("table") - F.col("score")) < 1e-9).alias("agrees"))
        same = same.join(agrees, "id").withColumn("same_score", F.col("same_score") & F.col("agrees")).drop("agrees")
    return same


def _all_test_scores(spark, sf, names=FITTED):
    """The test rows scored by each model, stacked."""
    scored = None
    for n in names:
        s = _test_scores(spark, sf, n).withColumn("model", F.lit(n))
        scored = s if scored is None else scored.unionByName(s)
    return scored


def model_metrics_df(spark, sf, names=FITTED):
    """Metrics of several models on the same test rows, evaluated together:
    the scored tables are stacked with a model column (unionByName) and
    grouped, so each metric is one pass for all models."""
    secs = spark.createDataFrame([(n, float(fitted(spark, sf, n)[1])) for n in names],
                                 "model string, train_seconds double")  # one row per model
    scored = IO.written(_all_test_scores(spark, sf, names), "test_scores")  # each model scores its rows once
    return EV.metric_rows(scored, "model").join(secs, "model", "left")


STORED = {"linear_stored": "scored", "boosted_stored": "boosted_scored"}
_CHAIN = SCORED_CTE[SCORED_CTE.index("sc AS ("):]
_NAMES = ("scored", "sc", "asc_cum", "desc_cum", "cm", "cls", "cls2", "cls3")


def _of_boosted(sql: str) -> str:
    """The SQL of the linear scorer's evaluation for the boosted one."""
    return re.sub(rf"\b({'|'.join(_NAMES)})\b", r"boosted_\1", sql)


STORED_METRICS_CTE = (SCORED_CTE + ",\n" + STORED_CTE + f",\nboosted_scored AS (SELECT * FROM boosted WHERE {IS_TEST}),\n"
                      + _of_boosted(_CHAIN))
_METRICS_SQL = (f"SELECT a.auc, b.accuracy, c.f1, d.precision, e.recall FROM ({AUC_SQL}) a, ({ACC_SQL}) b, ({W_SQL.format(m='f1')}) c, "
                f"({W_SQL.format(m='precision')}) d, ({W_SQL.format(m='recall')}) e")


def stored_scores(spark, sf):
    """The test rows scored by each stored scorer, stacked."""
    return (linear_scored(spark, sf).withColumn("model", F.lit("linear_stored"))
            .unionByName(boosted_scored(spark, sf, test_only=True).withColumn("model", F.lit("boosted_stored"))))


MEASURES = METRICS_SCHEMA.names
_SHARES = f"coalesce({' and '.join(f'{m} between 0 and 1' for m in MEASURES)}, false)"
_ABOVE = "coalesce(auc > 0.5, false)"


def _of_stored(measure: str):
    """A measure of a stored scorer; NULL for a fit, whose numbers no SQL can give."""
    return F.when(F.col("model").isin(*STORED), F.col(measure)).alias(measure)


@register("model_metrics", with_campaigns(
    f"SELECT model, {', '.join(f'CAST(NULL AS DOUBLE) AS {m}' for m in MEASURES)}, TRUE AS are_shares, TRUE AS auc_above_half "
    f"FROM (VALUES {_MODELS}) AS f(model) UNION ALL "
    f"SELECT 'linear_stored', m.*, {_SHARES}, {_ABOVE} FROM ({_METRICS_SQL}) m UNION ALL "
    f"SELECT 'boosted_stored', m.*, {_SHARES}, {_ABOVE} FROM ({_of_boosted(_METRICS_SQL)}) m", STORED_METRICS_CTE), "evaluation")
def model_metrics(spark, sf):
    """All fitted models and stored scorers on the test rows: the stored ones' measures, and of all of them
    whether these are shares and the AUC above a half. The fits' numbers are those of ``model_metrics_fitted``."""
    found = model_metrics_df(spark, sf).unionByName(EV.metric_rows(stored_scores(spark, sf), "model"), allowMissingColumns=True)
    return found.select("model", *map(_of_stored, MEASURES), F.expr(_SHARES).alias("are_shares"), F.expr(_ABOVE).alias("auc_above_half"))


@register("model_metrics_fitted", None, "evaluation")
def model_metrics_fitted(spark, sf):
    return model_metrics_df(spark, sf)


@register("metric_facts", f"SELECT model, TRUE AS are_shares, TRUE AS auc_above_half FROM (VALUES {_MODELS}) AS m(model)", "evaluation")
def metric_facts(spark, sf):
    """Per fitted model: that each measure is a share, and the AUC above a half."""
    return model_metrics_df(spark, sf).select("model", F.expr(_SHARES).alias("are_shares"), F.expr(_ABOVE).alias("auc_above_half"))


COMPARED = ("LR", "RF")


@register("model_comparison", None, "sets")
def model_comparison(spark, sf):
    """The MLlib models' metric table stacked with the rows of the stored scorers, from tables of their own: every
    measure of each, and whether its AUC is above a half."""
    linear = EV.metric_row(linear_scored(spark, sf), "linear_stored")
    boosted = EV.metric_row(boosted_scored(spark, sf, test_only=True), "boosted_stored", extra={"rounds": 3})
    stacked = model_metrics_df(spark, sf, COMPARED).unionByName(linear, allowMissingColumns=True)
    stacked = stacked.unionByName(boosted, allowMissingColumns=True)
    return stacked.withColumn("auc_above_half", F.expr(_ABOVE))


CURVE_SIZES, CURVE_FOLDS = np.linspace(0.1, 1.0, 8).tolist(), 3
_fold = f"CAST({hash_unit_sql('id', SEED, 'fold')} % {CURVE_FOLDS} AS INTEGER)"
_counts = "\nUNION ALL ".join(
    f"SELECT CAST('{s!r}' AS DOUBLE) AS train_fraction, f AS fold, COUNT(*) FILTER (WHERE fold <> f"
    + ("" if s >= 1.0 else f" AND {hash_unit_sql('id', SEED, 'sample')} < {SM.threshold(s)}") + ") AS n_train FROM tagged, folds GROUP BY f"
    for s in CURVE_SIZES)


def _curve(spark, sf):
    df = K.with_features(K.validate(model_table(spark, sf)))
    return _memo(spark, sf, "curve", lambda: _learning_curve(df, sizes=CURVE_SIZES, folds=CURVE_FOLDS, seed=SEED))


@register("learning_curve", None, "evaluation")
def learning_curve(spark, sf):
    return _curve(spark, sf)


@register("curve_facts", with_campaigns(f"""
SELECT estimator, train_fraction, ROUND(AVG(n_train), 1) AS n_train, TRUE AS are_aucs
FROM ({_counts}) c, (VALUES ('LR'), ('RF')) AS e(estimator) GROUP BY estimator, train_fraction""",
    VALIDATED_CTE + f""",
tagged AS (SELECT id, {_fold} AS fold FROM validated),
folds AS (SELECT unnest(range(0, {CURVE_FOLDS})) AS f)"""), "evaluation")
def curve_facts(spark, sf):
    """Which points a curve has, from how many rows, and that its values are AUCs."""
    aucs = "train_auc_mean between 0.5 and 1 and val_auc_mean between 0 and 1"
    return _curve(spark, sf).select("estimator", "train_fraction", "n_train", F.expr(f"coalesce({aucs}, false)").alias("are_aucs"))
