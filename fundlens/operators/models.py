"""Distributed model operators on MLlib: fit, cross-validate, inspect, score, store.

Training data is prepared once (select, derive, drop nulls), split by the
hash rule, and persisted for the iterative fits; fitted models are whole
pipelines (feature stages + estimator) so category codes always travel with
the model that learned them.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import prob_pos
from .clean import with_features
from .features import CATEGORICAL, FEATURE_COLS, feature_stages

LABEL = "state"
PREP_COLS = ["goal", "duration", "staff_pick", "category", "country", LABEL]


def prepare(df: DataFrame, key: str = "id") -> DataFrame:
    """Model table: key, goal, duration, integer staff_pick, category,
    country, state; rows with any NULL dropped (the assembler rejects them)."""
    return with_features(df).select(key, *PREP_COLS).dropna()


def max_bins_for(df: DataFrame, cols: Sequence[str] = CATEGORICAL, floor: int = 200) -> int:
    """Tree ``maxBins`` must exceed every categorical cardinality (+1 for the
    ``keep`` bucket); never hard-code the cardinality."""
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    return max(floor, max(int(row[c]) for c in cols) + 1)


def pipeline(estimator, handle_invalid: str = "keep", order: str = "frequencyDesc") -> Pipeline:
    return Pipeline(stages=feature_stages(handle_invalid, order) + [estimator])


def lr_estimator(max_iter: int = 100, reg_param: float = 0.01) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=max_iter, regParam=reg_param)


def rf_estimator(num_trees: int = 40, max_depth: int = 6, max_bins: int = 200, seed: int = 42):
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=num_trees,
                                  maxDepth=max_depth, maxBins=max_bins, seed=seed)


def dt_estimator(max_depth: int = 8, max_bins: int = 200, seed: int = 42):
    return DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, maxDepth=max_depth,
                                  maxBins=max_bins, seed=seed)


def gbt_estimator(max_bins: int = 200, seed: int = 42, max_iter: int = 10, max_depth: int = 3):
    # checkpointInterval takes effect because the session always has a
    # shared checkpoint dir (session.ensure_checkpoint_dir).
    return GBTClassifier(featuresCol="features", labelCol=LABEL, maxBins=max_bins, seed=seed,
                         maxIter=max_iter, maxDepth=max_depth, checkpointInterval=10)


def timed_fit(est, df: DataFrame):
    t0 = time.time()
    m = est.fit(df)
    return m, round(time.time() - t0, 2)


def fit_lr(train: DataFrame, max_iter: int = 100, reg_param: float = 0.01):
    return timed_fit(pipeline(lr_estimator(max_iter, reg_param)), train)


def fit_rf(train: DataFrame, num_trees: int = 40, max_depth: int = 6, seed: int = 42):
    return timed_fit(pipeline(rf_estimator(num_trees, max_depth, max_bins_for(train), seed)), train)


def fit_dt(train: DataFrame, max_depth: int = 8, seed: int = 42):
    return timed_fit(pipeline(dt_estimator(max_depth, max_bins_for(train), seed)), train)


# The grid of the boosted trees.
GBT_DEPTHS, GBT_ITERS = (3, 4), (10, 15)


class PrefixCrossValidator(CrossValidator):
    """Cross-validation of boosted trees that fits only the most rounds of the grid.

    A model of n rounds is the first n trees of one of more rounds (each round's seed depends on its number alone), so for
    each setting of the other parameters and each fold one model is fitted, and its prefixes are
    scored in one pass: every tree once per row (the model's own leaf numbers), a score for each number of rounds. The AUCs (exact,
    with ties) of all settings, folds and rounds come from one grouped evaluation. Last, the best setting is fitted on all rows.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        from ..sources.files import written
        from .ensembles import leaf_values, node_table, staged_scores
        from .evaluation import auc_of_counts, score_counts

        pipe, maps, folds = self.getEstimator(), self.getEstimatorParamMaps(), self.getNumFolds()
        gbt, fold = pipe.getStages()[-1], F.col(self.getFoldCol())
        rounds_of = [m.get(gbt.maxIter, gbt.getMaxIter()) for m in maps]
        others = [tuple(sorted((p.name, v) for p, v in m.items() if p != gbt.maxIter)) for m in maps]
        longest = {o: max(range(len(maps)), key=lambda i: (others[i] == o, rounds_of[i])) for o in dict.fromkeys(others)}

        def scored(task: tuple[int, int]) -> DataFrame:
            i, f = task
            model = pipe.fit(dataset.filter(fold != f), maps[i])
            own = dataset.filter(fold == f).filter(F.col(LABEL).isNotNull())
            trees = model.stages[-1]
            columns = leaf_values(node_table(trees, spark=dataset.sparkSession), F.col("_leaves"))
            wanted = sorted({rounds_of[k] for k in range(len(maps)) if others[k] == others[i]})
            leaves = trees.copy({trees.leafCol: "_leaf", trees.rawPredictionCol: "", trees.probabilityCol: "", trees.predictionCol: ""})
            rows = PipelineModel(stages=[*model.stages[:-1], leaves]).transform(own)
            rows = rows.select(F.lit(i).alias("setting"), F.lit(f).alias("fold"), F.col(LABEL).alias("label"),
                               vector_to_array("_leaf").alias("_leaves"))
            return staged_scores(rows, columns, wanted, ["setting", "fold", "label"])

        tasks = [(i, f) for i in longest.values() for f in range(folds)]
        with ThreadPoolExecutor(max_workers=self.getParallelism()) as pool:
            frames = list(pool.map(inheritable_thread_target(dataset.sparkSession)(scored), tasks))
        every = frames[0]
        for frame in frames[1:]:
            every = every.unionByName(frame)
        found: dict[tuple[int, int], list[float]] = {}
        # A row for each setting, fold and number of rounds.
        by = ["setting", "fold", "rounds"]
        counts = written(score_counts(every, group_cols=by), "cv_scores")  # so every row is scored once
        for r in auc_of_counts(counts, group_cols=by).collect():
            found.setdefault((r["setting"], r["rounds"]), []).append(r["auc"])
        each = [found[longest[o], n] for o, n in zip(others, rounds_of, strict=True)]
        means = [sum(x) / len(x) for x in each]
        spread = [(sum((v - m) ** 2 for v in x) / len(x)) ** 0.5 for x, m in zip(each, means, strict=True)]
        best = max(range(len(maps)), key=lambda i: means[i])
        return self._copyValues(CrossValidatorModel(pipe.fit(dataset, maps[best]), means, None, spread))


def gbt_cv(train_with_folds: DataFrame, depths: Sequence[int] = GBT_DEPTHS, iters: Sequence[int] = GBT_ITERS,
           fold_col: str = "fold", num_folds: int = 2, parallelism: int = 2, seed: int = 42) -> CrossValidator:
    gbt = gbt_estimator(max_bins_for(train_with_folds), seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxIter, list(iters)).build()
    ev = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    return PrefixCrossValidator(estimator=pipeline(gbt), estimatorParamMaps=grid, evaluator=ev,
                                foldCol=fold_col, numFolds=num_folds, parallelism=parallelism, seed=seed)


def fit_gbt_cv(train_with_folds: DataFrame, **kw):
    return timed_fit(gbt_cv(train_with_folds, **kw), train_with_folds)


def cv_results(cv_model: CrossValidatorModel) -> DataFrame:
    """One row per parameter combination: params, mean metric, best flag.
    Bounded by the grid size."""
    maps = cv_model.getEstimatorParamMaps()
    metrics = list(cv_model.avgMetrics)
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, (pm, m) in enumerate(zip(maps, metrics)):
        params = {p.name: v for p, v in pm.items()}
        rows.append((int(params.get("maxDepth", -1)), int(params.get("maxIter", -1)), round(float(m), 6), i == best))
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "maxDepth int, maxIter int, avg_auc double, is_best boolean")


def last_stage(model):
    if isinstance(model, CrossValidatorModel):
        model = model.bestModel
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def feature_importance(models: dict) -> DataFrame:
    """(model, feature, importance, rank) for tree models (bounded: features x models)."""
    from pyspark.sql import SparkSession

    rows = []
    for name, m in models.items():
        imp = last_stage(m).featureImportances.toArray().tolist()
        order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))
        for rank, i in enumerate(order, 1):
            rows.append((name, FEATURE_COLS[i], round(float(imp[i]), 6), rank))
    return SparkSession.getActiveSession().createDataFrame(
        rows, "model string, feature string, importance double, rank int")


def lr_coefficients(model, auc: float | None = None) -> DataFrame:
    """(term, value): one row per feature coefficient plus the intercept."""
    from pyspark.sql import SparkSession

    lr = last_stage(model)
    rows = [(f, float(c)) for f, c in zip(FEATURE_COLS, lr.coefficients.toArray().tolist())]
    rows.append(("intercept", float(lr.intercept)))
    if auc is not None:
        rows.append(("auc", float(auc)))
    return SparkSession.getActiveSession().createDataFrame(rows, "term string, value double")


def score_linear(df: DataFrame, coefficients: dict, intercept: float, score_col: str = "score",
                 prediction_col: str = "prediction", threshold: float = 0.5) -> DataFrame:
    """Logistic score from stored coefficients as one column expression (no
    model object, no Python per row)."""
    lin = F.lit(float(intercept))
    for c, w in coefficients.items():
        lin = lin + F.lit(float(w)) * F.col(c).cast("double")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-lin))
    return df.withColumn(score_col, score).withColumn(
        prediction_col, F.when(F.col(score_col) > threshold, 1.0).otherwise(0.0))


def score_model(model, df: DataFrame, key: str = "id") -> DataFrame:
    """(key, label, prediction, score) from a fitted pipeline."""
    return model.transform(df).select(key, F.col(LABEL).alias("label"), "prediction",
                                      prob_pos("probability").alias("score"))


def reuse_stage(feature_model: PipelineModel, stage, expected_labels: dict | None = None) -> PipelineModel:
    """Put an already fitted estimator stage behind fitted feature stages.

    ``expected_labels`` (column -> label list the stage was trained with)
    is checked against the indexers, so a changed frequency order cannot
    silently change category codes.
    """
    feats = list(feature_model.stages)
    if feats and feats[-1].hasParam("predictionCol"):
        feats = feats[:-1]  # a full pipeline: keep only its feature stages
    if expected_labels:
        have = indexer_labels(PipelineModel(stages=feats))
        for col, labels in expected_labels.items():
            if have.get(col) != list(labels):
                raise ValueError(f"indexer labels for {col} differ from the trained stage")
    return PipelineModel(stages=feats + [stage])


def indexer_labels(model) -> dict:
    if isinstance(model, CrossValidatorModel):
        model = model.bestModel
    out = {}
    for s in model.stages:
        if hasattr(s, "labelsArray"):
            cols = s.getInputCols() if s.isSet("inputCols") else [s.getInputCol()]
            out.update({c: list(lab) for c, lab in zip(cols, s.labelsArray)})
    return out


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
