"""Evaluation operators against MLlib evaluators and brute force (score_edges)."""

import math
import random

import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from fundlens.operators import evaluation as EV
from fundlens.operators.ordered import key_range, running_sums


def _scored(spark, n=3000, seed=7, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.4 else 0
        s = rnd.random() * 0.6 + 0.3 * y
        if ties:
            s = round(s, 2)  # many tied scores
        rows.append((i, y, s, 1.0 if s > 0.5 else 0.0))
    return spark.createDataFrame(rows, "id long, label int, score double, prediction double")


def _brute_auc(pdf):
    pos = pdf[pdf.label == 1].score.tolist()
    neg = pdf[pdf.label == 0].score.tolist()
    num = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return num / (len(pos) * len(neg))


@pytest.mark.parametrize("fineness", [1, 7, 256])
def test_auc_exact_with_ties(spark, fineness):
    df = _scored(spark, 1200)
    got = EV.auc(df, fineness=fineness).first()["auc"]
    assert got == round(_brute_auc(df.toPandas()), 6)


def test_auc_equals_evaluator_unbinned(spark):
    df = _scored(spark, 5000, ties=False)
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    mllib = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert abs(EV.auc(df).first()["auc"] - mllib) < 1e-6


def test_weighted_metrics_equal_mllib(spark):
    df = _scored(spark, 4000).withColumn("label", F.col("label").cast("double"))
    wm = EV.weighted_metrics(df).first()
    for ours, name in [("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")]:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert abs(wm[ours] - ev.evaluate(df)) < 1e-6
    acc = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    assert abs(EV.accuracy(df).first()["accuracy"] - acc.evaluate(df)) < 1e-6


def test_class_never_predicted_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1, 0.0), (1, 0.2, 0.0), (1, 0.3, 0.0)], "label int, score double, prediction double")
    wm = EV.weighted_metrics(df).first()
    # class 1 is never predicted: its precision counts as 0
    assert wm["precision"] == round((1 / 3) * (1 / 3), 6)
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_matrix(df).collect()}
    assert cm == {(0.0, 0.0): 1, (0.0, 1.0): 0, (1.0, 0.0): 2, (1.0, 1.0): 0}


def test_single_class_auc_null(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.9)], "label int, score double")
    assert EV.auc(df).first()["auc"] is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "label int, score double, prediction double")
    assert EV.auc(df).first()["auc"] is None
    assert EV.roc_points(df).count() == 0


def test_roc_pr_ap_brute_force(spark):
    df = _scored(spark, 800)
    pdf = df.toPandas()
    P, N = (pdf.label == 1).sum(), (pdf.label == 0).sum()
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in EV.roc_points(df, fineness=5).collect()}
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in EV.pr_points(df, fineness=5).collect()}
    ap = 0.0
    for t in sorted(pdf.score.unique(), reverse=True):
        sel = pdf[pdf.score >= t]
        tp, fp = (sel.label == 1).sum(), (sel.label == 0).sum()
        assert roc[round(t, 6)] == (round(fp / N, 6), round(tp / P, 6))
        assert pr[round(t, 6)] == (round(tp / (tp + fp), 6), round(tp / P, 6))
        ap += ((pdf[pdf.score == t].label == 1).sum() / P) * (tp / (tp + fp))
    assert EV.average_precision(df, fineness=5).first()["average_precision"] == round(ap, 6)


def test_nan_scores_rank_nowhere(spark):
    rows = [(1, 0.9), (0, 0.4), (1, 0.6), (0, 0.7), (1, float("nan")), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    points = sorted((r["fpr"], r["tpr"]) for r in EV.roc_points(df).collect())
    points = [(0.0, 0.0), *points, (1.0, 1.0)]
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(points, points[1:]))
    assert EV.auc(df).first()["auc"] == round(area, 6) == 0.75
    assert not any(math.isnan(r["precision"]) for r in EV.pr_points(df).collect())


def test_ranges_never_fall(spark):
    r = random.Random(9)
    keys = [r.uniform(0, 1) for _ in range(500)] + [2.0 ** -n for n in range(0, 1075, 7)] + [1 - 2.0 ** -n for n in range(1, 54)]
    keys += [math.nextafter(x, 2) for x in keys] + [math.nextafter(x, -1) for x in keys] + [0.0, 1e300, -3.5, -1e-300, 7.0]
    df = spark.createDataFrame([(k,) for k in keys], "k double")
    for fineness in (1, 1024):
        got = [r["r"] for r in df.select("k", key_range(F.col("k"), fineness).alias("r")).orderBy("k").collect()]
        assert got == sorted(got)
    assert len(set(got)) > 500


def test_running_sums_brute_force(spark):
    rnd = random.Random(3)
    rows = [(float(k), rnd.randint(0, 9)) for k in rnd.sample(range(10000), 2000)]
    df = spark.createDataFrame(rows, "k double, v long")
    pdf = pd.DataFrame(rows, columns=["k", "v"]).sort_values("k")
    pdf["cum"] = pdf.v.cumsum()
    for desc in (False, True):
        out = {r["k"]: (r["cum_v"], r["tot_v"]) for r in running_sums(df, "k", ["v"], descending=desc, fineness=13).collect()}
        ref = pdf.sort_values("k", ascending=not desc).assign(c=lambda d: d.v.cumsum())
        for k, c in zip(ref.k, ref.c):
            assert out[k] == (c, pdf.v.sum())


def test_hot_score_is_one_row(spark):
    # a third of all rows share one score: aggregation collapses it before any window
    rows = [(1 if i % 3 else 0, 0.5) for i in range(3000)] + [(i % 2, i / 3000) for i in range(6000)]
    df = spark.createDataFrame(rows, "label int, score double")
    counts = EV.score_counts(df)
    assert counts.filter(F.col("score") == 0.5).count() == 1
    assert EV.auc(df).first()["auc"] is not None


def test_binary_path_equals_generic(spark):
    df = _scored(spark, 2000)
    a = EV.weighted_metrics(df).first()
    b = EV.weighted_metrics(df, classes=(0.0, 1.0)).first()
    assert a == b


def test_metric_row_agrees_with_single_metrics(spark):
    df = _scored(spark, 1500)
    row = EV.metric_row(df, "m").first()
    assert row["auc"] == EV.auc(df).first()["auc"]
    assert row["accuracy"] == EV.accuracy(df).first()["accuracy"]
    wm = EV.weighted_metrics(df).first()
    assert (row["f1"], row["precision"], row["recall"]) == (wm["f1"], wm["precision"], wm["recall"])


def test_grouped_metrics_equal_per_group(spark):
    a = _scored(spark, 1500, seed=1).withColumn("model", F.lit("a"))
    b = _scored(spark, 900, seed=2).withColumn("model", F.lit("b"))
    grouped = {r["model"]: r.asDict() for r in EV.metric_rows(a.unionByName(b), "model").collect()}
    for name, df in (("a", a), ("b", b)):
        single = EV.metric_row(df.drop("model"), name).first().asDict()
        assert grouped[name] == single


def test_all_null_labels_give_null_metrics(spark):
    df = spark.createDataFrame([(None, 0.3, 1.0), (None, 0.7, 0.0)], "label int, score double, prediction double")
    wm = EV.weighted_metrics(df, classes=(0.0, 1.0)).first()
    assert (wm["precision"], wm["recall"], wm["f1"]) == (None, None, None)
    row = EV.metric_row(df, "m").first()
    assert row["auc"] is None and row["accuracy"] is None
