"""MLlib model operators: invariants (rows-only keys in the registry)."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from conftest import SF_SMALL
from fundlens.operators import evaluation as EV
from fundlens.operators import features as FT
from fundlens.operators import models as M
from fundlens.plans import q_models as Q
from fundlens.session import scratch_path


@pytest.fixture(scope="module")
def split(spark):
    return Q.train_test(spark, SF_SMALL)


def test_lr_auc_above_chance(spark):
    scores = Q._test_scores(spark, SF_SMALL, "LR")
    a = EV.auc(scores).first()["auc"]
    assert 0.5 < a <= 1.0


def test_tree_importances_sum_to_one(spark):
    fi = M.feature_importance({n: Q.fitted(spark, SF_SMALL, n)[0] for n in ("RF", "DT", "GBT")}).toPandas()
    for _, g in fi.groupby("model"):
        assert abs(g.importance.sum() - 1.0) < 1e-4
        assert sorted(g["rank"]) == list(range(1, len(FT.FEATURE_COLS) + 1))


def test_cv_results_one_best(spark):
    cv = M.cv_results(Q.fitted(spark, SF_SMALL, "GBT")[0]).toPandas()
    assert len(cv) == 4 and cv.is_best.sum() == 1


def test_model_store_same_scores(spark):
    assert all(r["same_score"] for r in Q.model_store(spark, SF_SMALL).collect())


def test_reuse_stage_rejects_changed_labels(spark):
    model = Q.fitted(spark, SF_SMALL, "LR")[0]
    labels = M.indexer_labels(model)
    bad = {k: list(reversed(v)) for k, v in labels.items()}
    with pytest.raises(ValueError):
        M.reuse_stage(model, model.stages[-1], bad)
    assert isinstance(M.reuse_stage(model, model.stages[-1], labels), PipelineModel)


def test_log_goal_transformer_save_load(spark):
    df = spark.createDataFrame([(0.0,), (9.0,)], "goal double")
    pm = Pipeline(stages=[FT.LogGoalTransformer()]).fit(df)
    path = scratch_path(spark, "tx")
    pm.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert [round(r["goal_log"], 6) for r in back.transform(df).collect()] == [0.0, round(np.log1p(9.0), 6)]


def test_max_bins_follows_cardinality(spark):
    df = spark.createDataFrame([(str(i), "x") for i in range(250)], "category string, country string")
    assert M.max_bins_for(df) == 251


def test_indexer_keep_unseen_and_null(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "category string")
    m = FT.indexers(["category"])[0].fit(train)
    assert list(m.labelsArray[0]) == ["b", "c", "a"]  # frequency desc, then value asc
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "category string")
    got = [r["category_index"] for r in m.transform(test).collect()]
    assert got == [2.0, 3.0, 3.0]


def test_score_linear_is_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    out = M.score_linear(df, {"x": 1.0}, -2.0).collect()
    assert out[0]["score"] == pytest.approx(1 / (1 + np.exp(2.0)))
    assert out[1]["score"] == 0.5 and out[1]["prediction"] == 0.0


def test_learning_curve_shape(spark):
    from fundlens.operators import clean as K
    from fundlens.operators.learning import learning_curve
    from fundlens.plans.q_clean import model_table

    df = K.with_features(K.validate(model_table(spark, SF_SMALL)))
    lc = learning_curve(df, sizes=[0.5, 1.0], folds=2).toPandas()
    assert len(lc) == 2 * 2
    assert lc.val_auc_mean.between(0, 1).all()


def test_learning_curve_equals_an_evaluator_for_each_fit(spark, monkeypatch):
    """One pass for all models gives what MLlib's exact evaluator gives for each of them."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.sql import functions as F

    from fundlens.operators import clean as K
    from fundlens.operators import learning as L
    from fundlens.plans.q_clean import model_table

    seen = []
    old = L._scores
    monkeypatch.setattr(L, "_scores", lambda d, m, p: (seen.append((d.checkpoint(), m, p)), old(d, m, p))[1])
    df = K.with_features(K.validate(model_table(spark, SF_SMALL)))
    got = {(r["estimator"], r["train_fraction"]): r for r in L.learning_curve(df, sizes=[0.4, 1.0], folds=2).collect()}
    (data, models, parts), = seen
    ev = BinaryClassificationEvaluator(labelCol="state", rawPredictionCol="probability", numBins=0)
    aucs = [[ev.evaluate(m.transform(data.filter(p == part)).withColumn("state", F.col("state").cast("double")))
             for part in ("train", "val")] for m, p in zip(models, parts)]
    for k, key in enumerate((n, s) for n in ("LR", "RF") for s in (0.4, 1.0)):
        own = aucs[2 * k:2 * k + 2]
        assert got[key]["train_auc_mean"] == pytest.approx(sum(a for a, _ in own) / 2, abs=2e-6)
        assert got[key]["val_auc_mean"] == pytest.approx(sum(b for _, b in own) / 2, abs=2e-6)


def test_indexer_error_mode_raises_on_unseen(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    train = spark.createDataFrame([("a",), ("b",)], "category string")
    m = FT.indexers(["category"], handle_invalid="error")[0].fit(train)
    with pytest.raises((PySparkException, Py4JJavaError)):
        m.transform(spark.createDataFrame([("zzz",)], "category string")).collect()


def test_cv_model_save_load(spark):
    from pyspark.ml.tuning import CrossValidatorModel

    cv = Q.fitted(spark, SF_SMALL, "GBT")[0]
    path = scratch_path(spark, "cv")
    cv.write().overwrite().save(path)
    back = CrossValidatorModel.load(path)
    _, test = Q.train_test(spark, SF_SMALL)
    a = sorted(M.score_model(cv, test).collect())
    b = sorted(M.score_model(back, test).collect())
    assert a == b and list(back.avgMetrics) == list(cv.avgMetrics)


def test_model_metrics_of_all_fits_and_stored_scorers(spark):
    rows = {r["model"]: r for r in Q.model_metrics(spark, SF_SMALL).collect()}
    assert set(rows) == {*Q.FITTED, *Q.STORED}
    assert all(r["are_shares"] for r in rows.values())
    assert all(rows[n]["auc"] is not None for n in Q.STORED)
    fitted = {r["model"]: r for r in Q.model_metrics_fitted(spark, SF_SMALL).collect()}
    assert all(rows[n]["auc_above_half"] == (fitted[n]["auc"] > 0.5) for n in Q.FITTED)


def test_model_comparison_stacks_fits_and_stored_scorers(spark):
    rows = {r["model"]: r for r in Q.model_comparison(spark, SF_SMALL).collect()}
    assert set(rows) == {*Q.COMPARED, *Q.STORED}
    assert all(rows[n]["auc"] is not None and rows[n]["auc_above_half"] == (rows[n]["auc"] > 0.5) for n in Q.STORED)
    fitted = {r["model"]: r["auc"] for r in Q.model_metrics_fitted(spark, SF_SMALL).collect()}
    assert all(rows[n]["auc_above_half"] == (fitted[n] > 0.5) for n in Q.COMPARED)


def test_model_comparison_has_every_number(spark, duck_small):
    """A fit's row has the measures of its evaluation, a stored scorer's those of DuckDB; none is nulled or left out."""
    from fundlens.plans.oracle import with_campaigns

    rows = {r["model"]: r for r in Q.model_comparison(spark, SF_SMALL).collect()}
    fitted = {r["model"]: r for r in Q.model_metrics_fitted(spark, SF_SMALL).collect()}
    assert all(rows[n][m] is not None and rows[n][m] == fitted[n][m] for n in Q.COMPARED for m in [*Q.MEASURES, "train_seconds"])
    of_both = (f"SELECT 'linear_stored' AS model, m.* FROM ({Q._METRICS_SQL}) m UNION ALL "
               f"SELECT 'boosted_stored', m.* FROM ({Q._of_boosted(Q._METRICS_SQL)}) m")
    want = duck_small.execute(with_campaigns(of_both, Q.STORED_METRICS_CTE)).fetchall()
    assert sorted(want) == sorted((n, *(rows[n][m] for m in Q.MEASURES)) for n in Q.STORED)
    assert rows["boosted_stored"]["rounds"] == 3


@pytest.mark.parametrize("run", ["cv", "curve"])
def test_evaluation_scores_each_row_once(spark, monkeypatch, run):
    """The evaluation reads written counts: read three times, it must not score three times."""
    from fundlens.operators import clean as K
    from fundlens.operators import learning as L
    from fundlens.plans.q_clean import model_table

    read = []
    old = EV.auc_of_counts
    spy = lambda counts, *a, **k: (read.append(counts._jdf.queryExecution().toString()), old(counts, *a, **k))[1]
    monkeypatch.setattr(EV, "auc_of_counts", spy)
    monkeypatch.setattr(L, "auc_of_counts", spy)
    if run == "cv":
        train, _ = Q.train_test(spark, SF_SMALL)
        M.fit_gbt_cv(train, depths=(2,), iters=(1, 2), num_folds=2)
    else:
        L.learning_curve(K.with_features(K.validate(model_table(spark, SF_SMALL))), sizes=[1.0], folds=2)
    assert len(read) == 1 and "FileScan" in read[0] and "UDF" not in read[0]


def test_leaf_numbers_find_the_values_of_the_nodes(spark, split):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from fundlens.operators import ensembles as ENS

    train, test = split
    model = M.pipeline(M.gbt_estimator(max_iter=4, max_depth=3)).fit(train)
    table = ENS.node_table(model, spark=spark).collect()
    trees = model.stages[-1]
    rows = PipelineModel(stages=[*model.stages[:-1], trees.copy({trees.leafCol: "leaf"})]).transform(test)
    by_leaf = ENS.leaf_values(table, vector_to_array("leaf"))
    by_node, _ = ENS.tree_values(table)
    got = rows.select(F.array(*by_leaf).alias("a"), F.array(*by_node).alias("b"), F.col("probability"),
                      ENS.score(by_leaf, False).alias("s")).collect()
    assert got and all(r["a"] == r["b"] and r["s"] == pytest.approx(r["probability"][1], abs=1e-12) for r in got)


def _curve_rows(spark, n=400):
    """Rows of a learning curve whose outcome leans on the goal."""
    from pyspark.sql import functions as F

    lean = (F.col("id") * 7919 % 1000 / 1000 + F.col("id") % 13 / 13 > 1).cast("int")
    return spark.range(n).select("id", (F.col("id") % 13 / 3.0 + 1).alias("goal_log"), (F.col("id") % 97 * 86400).alias("duration"),
                                 (F.col("id") % 5 == 0).cast("int").alias("staff_pick"), F.concat(F.lit("c"), F.col("id") % 4).alias("category"),
                                 F.concat(F.lit("n"), F.col("id") % 7).alias("country"), lean.alias("state"))


def test_fits_of_a_curve_hash_no_row(spark):
    """A row's place among the samples is kept with it: 48 fits of several passes each would hash it anew."""
    from pyspark.ml.classification import LogisticRegression

    from fundlens.operators import learning as L

    plans = []

    class Seen(LogisticRegression):
        def _fit(self, dataset):
            plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
            return super()._fit(dataset)

    est = Seen(featuresCol="features", labelCol="state", maxIter=5)
    rows = L.learning_curve(_curve_rows(spark), sizes=[0.5, 1.0], folds=2, estimators={"LR": est}).collect()
    assert len(rows) == 2 and len(plans) == 4
    assert all("InMemoryRelation" in p and "md5" not in p.split("InMemoryRelation")[0] for p in plans)


def test_curve_computes_each_score_once(spark):
    """The filter of the counts is not pushed below a score, which would compute it again for each condition."""
    from pyspark.sql import functions as F

    from fundlens.operators import learning as L

    data = FT.assembler(["id", "goal_log"]).transform(_curve_rows(spark)).select("features", "state", F.expr("id % 3").alias("fold"))
    ests = L.default_estimators()
    models = [ests["LR"].fit(data), ests["RF"].fit(data)]
    parts = [F.when(F.col("fold") != f, "train").when(F.col("fold") == f, "val") for f in range(2)]
    counts = EV.score_counts(L._scores(data.checkpoint(), models, parts), group_cols=["cell"])
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("UDF(") == 3  # a forest's votes, two vectors read
    assert {r["cell"] for r in counts.collect()} == {0, 1, 2, 3}


def test_fits_wait_for_room():
    """Fits that keep more rows than fit into memory run one after the other, even one that never fits."""
    import threading
    import time
    from concurrent.futures import ThreadPoolExecutor

    from fundlens.operators import learning as L

    room, guard, held, most = L.Room(100), threading.Lock(), [], []

    def use(need):
        with room.taken(need):
            with guard:
                held.append(need)
                most.append(list(held))
            time.sleep(0.02)
            with guard:
                held.remove(need)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(use, [60, 30, 500, 10, 60, 60, 20, 500]))
    assert all(sum(x) <= 100 or len(x) == 1 for x in most) and sum(500 in x for x in most) == 2 and room.used == room.users == 0
