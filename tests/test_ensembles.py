"""Node tables of fitted trees score as the models do; boosting by prefixes equals the full grid."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundlens.operators import ensembles as ENS
from fundlens.operators import models as M
from fundlens.plans import q_models as Q
from fundlens.session import scratch_path


def both(spark, name, table=None):
    """The model's and the table's scores of all prepared rows, and of some with categories that the fit never saw."""
    model = Q.fitted(spark, SF_SMALL, name)[0]
    rows = Q.prepared(spark, SF_SMALL)
    rows = rows.unionByName(rows.limit(50).withColumn("category", F.lit("never seen")))
    stages = (model.bestModel if name == "GBT" else model).stages
    indexed = PipelineModel(stages=stages[:-1]).transform(rows)
    direct = stages[-1].transform(indexed)
    table = table if table is not None else ENS.node_table(model)
    return ENS.score_table(direct.withColumnRenamed("prediction", "of_model"), table), table


@pytest.mark.parametrize("name", ["DT", "RF", "GBT"])
def test_table_equals_model(spark, name):
    scored, _ = both(spark, name)
    from pyspark.ml.functions import vector_to_array

    far = scored.select(F.abs(vector_to_array("probability")[1] - F.col("score")).alias("d"),
                        (F.col("prediction") != F.col("of_model")).cast("int").alias("x"))
    got = far.agg(F.max("d").alias("d"), F.sum("x").alias("x"), F.count(F.lit(1)).alias("n")).first()
    assert got["n"] > 500 and got["d"] < 1e-9 and got["x"] == 0


def test_written_table_equals_model(spark):
    _, table = both(spark, "RF")
    path = scratch_path(spark, "nodes")
    table.write.parquet(path)
    back = spark.read.parquet(path)
    assert back.schema.simpleString() == spark.createDataFrame([], ENS.NODE_SCHEMA).schema.simpleString()
    scored, _ = both(spark, "RF", back)
    first, _ = both(spark, "RF", table)
    assert scored.select("id", "score").exceptAll(first.select("id", "score")).count() == 0


@pytest.mark.parametrize("name", ["DT", "RF", "GBT"])
def test_importances_equal_the_models(spark, name):
    model = Q.fitted(spark, SF_SMALL, name)[0]
    got = {r["feature"]: r["importance"] for r in ENS.importances(ENS.node_table(model)).collect()}
    want = {r["feature"]: r["importance"] for r in M.feature_importance({name: model}).collect()}
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 2e-6 for f in got)


def test_statistics_on_the_training_rows_are_the_fits_own(spark):
    model = Q.fitted(spark, SF_SMALL, "DT")[0]
    train, _ = Q.train_test(spark, SF_SMALL)
    rows = PipelineModel(stages=model.stages[:-1]).transform(train)
    table = ENS.node_table(model)
    got = {(r["tree"], r["node"]): (r["n"], r["gain"]) for r in ENS.on_rows(rows, table, M.LABEL).collect()}
    for r in table.collect():
        n, gain = got[r["tree"], r["node"]]
        assert n == r["n"] and (gain is None) == (r["gain"] is None) and abs((gain or 0) - (r["gain"] or 0)) < 1e-9


def test_not_a_tree(spark):
    with pytest.raises(ValueError, match="not a tree"):
        ENS.node_table(Q.fitted(spark, SF_SMALL, "LR")[0])


def test_prefixes_equal_the_full_grid(spark):
    train, _ = Q.train_test(spark, SF_SMALL)
    cv = M.gbt_cv(train, depths=(2, 3), iters=(2, 4))
    fits = []
    pipe = cv.getEstimator()
    old = type(pipe).fit
    try:
        type(pipe).fit = lambda self, df, params=None: (fits.append(params), old(self, df, params))[1]
        got = cv.fit(train)
    finally:
        type(pipe).fit = old
    assert len(fits) == 2 * 2 + 1  # depths by folds, and the best one
    exact = BinaryClassificationEvaluator(labelCol=M.LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    full = CrossValidator(estimator=pipe, estimatorParamMaps=cv.getEstimatorParamMaps(), evaluator=exact,
                          foldCol="fold", numFolds=2, parallelism=2, seed=42)
    want = CrossValidator._fit(full, train)
    assert [round(m, 5) for m in got.avgMetrics] == [round(m, 5) for m in want.avgMetrics]
    assert [round(m, 5) for m in got.stdMetrics] == [round(m, 5) for m in want.stdMetrics]
    a, b = (m.bestModel.stages[-1] for m in (got, want))
    assert a.getNumTrees == b.getNumTrees and a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]
