"""Binary-classifier evaluation on Spark (label, prediction, score columns).

Nothing is collected: scores are aggregated per distinct value (partial
aggregation map-side, so a single hot score is one row), running sums use
``ordered.running_sums`` (no single-task global window), and the class
metrics come from the tiny confusion table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import FINENESS, running_sums

DIGITS = 6


def _r(c: Column) -> Column:
    return F.round(c, DIGITS)


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """(groups..., score, pos, neg): one row per distinct score. Rows without a
    label, or whose score is NULL or NaN, rank nowhere and are left out by all curves alike."""
    pos = F.col(label) == 1
    return (df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
              .groupBy(*group_cols, F.col(score).alias("score"))
              .agg(F.sum(F.when(pos, 1).otherwise(0)).cast("long").alias("pos"),
                   F.sum(F.when(pos, 0).otherwise(1)).cast("long").alias("neg")))


def auc(df: DataFrame, label: str = "label", score: str = "score", fineness: int = FINENESS,
        group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact area under ROC with ties (Mann-Whitney): equals MLlib's evaluator
    with ``numBins=0``. NULL when one class is absent. One row, or one per
    ``group_cols`` group (e.g. several models scored on the same rows)."""
    return auc_of_counts(score_counts(df, label, score, group_cols), fineness, group_cols)


def auc_of_counts(counts: DataFrame, fineness: int = FINENESS, group_cols: Sequence[str] = ()) -> DataFrame:
    """``auc`` of the rows of ``score_counts``. They are read three times, for the running sums and both levels of their
    offsets: a caller whose scores are costly writes the counts first."""
    g = list(group_cols)
    c = running_sums(counts, "score", ["neg"], descending=False, fineness=fineness, group_cols=g)
    below = F.col("cum_neg") - F.col("neg")
    u = F.sum(F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") / 2))
    p, n = F.sum("pos"), F.sum("neg")
    out = _r(_div(u, p.cast("double") * n.cast("double"))).alias("auc")
    return c.groupBy(*g).agg(out) if g else c.agg(out)


def _desc_curve(df, label, score, fineness):
    return running_sums(score_counts(df, label, score), "score", ["pos", "neg"], descending=True,
                        fineness=fineness)


def roc_points(df: DataFrame, label: str = "label", score: str = "score", fineness: int = FINENESS) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, scores >= threshold positive."""
    c = _desc_curve(df, label, score, fineness)
    return c.select(_r(F.col("score")).alias("threshold"),
                    _r(_div(F.col("cum_neg"), F.col("tot_neg"))).alias("fpr"),
                    _r(_div(F.col("cum_pos"), F.col("tot_pos"))).alias("tpr"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score", fineness: int = FINENESS) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    c = _desc_curve(df, label, score, fineness)
    return c.select(_r(F.col("score")).alias("threshold"),
                    _r(_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    _r(_div(F.col("cum_pos"), F.col("tot_pos"))).alias("recall"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      fineness: int = FINENESS) -> DataFrame:
    """Step-sum AP: sum over thresholds of (recall increment) x precision.
    Differs from MLlib's trapezoidal ``areaUnderPR``."""
    c = _desc_curve(df, label, score, fineness)
    term = _div(F.col("pos"), F.col("tot_pos")) * _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return c.agg(_r(F.sum(term)).alias("average_precision"))


def positive_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(_r(F.avg(F.col(label).cast("double"))).alias("positive_rate"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label).cast("double") == F.col(prediction).cast("double"), 1.0).otherwise(0.0)
    return df.agg(_r(F.avg(hit)).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) for observed combinations (k classes -> <= k^2 rows)."""
    return df.groupBy(F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """Counts per (label, prediction) over the ``classes`` grid, zero cells
    kept; one conditional-aggregation pass, no join."""
    aggs, names = [], []
    for a in classes:
        for b in classes:
            name = f"c_{len(names)}"
            cond = (F.col(label).cast("double") == float(a)) & (F.col(prediction).cast("double") == float(b))
            aggs.append(F.count_if(cond).alias(name))
            names.append((float(a), float(b), name))
    stack = ", ".join(f"CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), {n}" for a, b, n in names)
    return df.agg(*aggs).selectExpr(f"stack({len(names)}, {stack}) AS (label, prediction, n)")


def class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: support, predicted, tp, precision, recall, f1 (0 on zero division)."""
    cm = confusion_counts(df, label, prediction)
    by_label = cm.groupBy(F.col("label").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    st = by_label.join(by_pred, "class", "full_outer").fillna(0, ["support", "tp", "predicted"])
    prec = F.coalesce(_div(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(_div(F.col("tp"), F.col("support")), F.lit(0.0))
    st = st.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return st.withColumn("f1", f1)


def binary_class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       classes: Sequence[float] = (0.0, 1.0), group_cols: Sequence[str] = ()) -> DataFrame:
    """``class_stats`` for a known class list in one conditional-aggregation
    pass (no grouping of the confusion table, no join), per group if given."""
    g = list(group_cols)
    lab, pred = F.col(label).cast("double"), F.col(prediction).cast("double")
    aggs = []
    for i, c in enumerate(classes):
        aggs += [F.sum(F.when(lab == float(c), 1).otherwise(0)).cast("long").alias(f"s{i}"),
                 F.sum(F.when(pred == float(c), 1).otherwise(0)).cast("long").alias(f"p{i}"),
                 F.sum(F.when((lab == float(c)) & (pred == float(c)), 1).otherwise(0)).cast("long").alias(f"t{i}")]
    stack = ", ".join(f"CAST({float(c)} AS DOUBLE), s{i}, p{i}, t{i}" for i, c in enumerate(classes))
    agg = df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)
    st = agg.selectExpr(*[f"`{c}`" for c in g], f"stack({len(classes)}, {stack}) AS (class, support, predicted, tp)")
    prec = F.coalesce(_div(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(_div(F.col("tp"), F.col("support")), F.lit(0.0))
    st = st.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return st.withColumn("f1", f1)


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence[float] | None = None) -> DataFrame:
    """Support-weighted precision, recall and F1 (one row). With ``classes``
    given (the binary case) the counts come from one pass; otherwise the
    classes are discovered from the confusion table."""
    st = (binary_class_stats(df, label, prediction, classes) if classes
          else class_stats(df, label, prediction))
    w = F.col("support").cast("double")
    tot = F.sum(w)
    return st.agg(_r(F.try_divide(F.sum(w * F.col("precision")), tot)).alias("precision"),
                  _r(F.try_divide(F.sum(w * F.col("recall")), tot)).alias("recall"),
                  _r(F.try_divide(F.sum(w * F.col("f1")), tot)).alias("f1"))


def metric_rows(df: DataFrame, group_col: str = "model", label: str = "label", prediction: str = "prediction",
                score: str = "score") -> DataFrame:
    """One row per ``group_col`` value (e.g. per model): auc, accuracy, f1,
    precision, recall.

    All groups are evaluated together: AUC comes from one grouped running-sum
    pass and the class metrics from one grouped conditional aggregation. A
    caller whose scores are costly persists them.
    """
    df = df.select(group_col, label, prediction, score)
    a = auc(df, label, score, group_cols=[group_col])
    # accuracy and the weighted metrics share one pass of class counts
    st = binary_class_stats(df, label, prediction, (0.0, 1.0), group_cols=[group_col])
    w = F.col("support").cast("double")
    tot = F.sum(w)
    cls = st.groupBy(group_col).agg(
        _r(F.try_divide(F.sum(F.col("tp").cast("double")), tot)).alias("accuracy"),
        _r(F.try_divide(F.sum(w * F.col("f1")), tot)).alias("f1"),
        _r(F.try_divide(F.sum(w * F.col("precision")), tot)).alias("precision"),
        _r(F.try_divide(F.sum(w * F.col("recall")), tot)).alias("recall"))
    # both sides have one row per group (a handful of models)
    return a.join(cls, group_col, "full_outer").select(
        group_col, "auc", "accuracy", "f1", "precision", "recall")


def metric_row(df: DataFrame, model: str, label: str = "label", prediction: str = "prediction",
               score: str = "score", extra: dict | None = None) -> DataFrame:
    """One row: model, auc, accuracy, f1, precision, recall (+ extra literals)."""
    out = metric_rows(df.withColumn("model", F.lit(model)), "model", label, prediction, score)
    for name, v in (extra or {}).items():
        out = out.withColumn(name, F.lit(v))
    return out
