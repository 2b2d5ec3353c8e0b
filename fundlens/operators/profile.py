"""Data profile: counts, describe, fixed-split histograms.

Histograms use MLlib's ``Bucketizer`` (right-open buckets, the last one
closed, NaN to an extra bucket with ``handleInvalid='keep'``). The merged
table is computed in one pass: each row emits its two bucket ids through
``stack`` and a single grouped count produces both columns, so there is no
join of two histograms.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def linear_splits(lo: float, hi: float, n_buckets: int, open_last: bool = True) -> list[float]:
    """``n_buckets`` equal buckets on [lo, hi], plus an overflow bucket to +inf."""
    splits = np.linspace(lo, hi, n_buckets + 1).tolist()
    return splits + [float("inf")] if open_last else splits


# Histogram ranges and bucket count of the feature profile.
GOAL_SPLITS = linear_splits(0, 5_000_000, 60)
GOAL_LOG_SPLITS = linear_splits(0, 16, 60)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def class_distribution(df: DataFrame, label: str = "state") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols: Sequence[str] = ("country", "category"), approx: bool = False) -> DataFrame:
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(*[fn(c).alias(f"n_{c}") for c in cols])


DESCRIBE_STATS = ["count", "mean", "stddev", "min", "max"]


def describe(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Long-form (statistic, col...) table like ``DataFrame.describe`` but numeric,
    from a single aggregation."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"stddev__{c}"), F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}")]
    one = df.agg(*aggs)
    parts = []
    for s in DESCRIBE_STATS:
        parts.append(f"'{s}'")
        parts += [f"round(`{s}__{c}`, {digits})" for c in cols]
    names = ", ".join(["statistic"] + [f"`{c}`" for c in cols])
    return one.selectExpr(f"stack({len(DESCRIBE_STATS)}, {', '.join(parts)}) AS ({names})")


def bucketize(df: DataFrame, input_col: str, output_col: str, splits: Sequence[float],
              handle_invalid: str = "keep") -> DataFrame:
    b = Bucketizer(splits=list(splits), inputCol=input_col, outputCol=output_col, handleInvalid=handle_invalid)
    return b.transform(df).withColumn(output_col, F.col(output_col).cast("int"))


def histogram(df: DataFrame, col: str, splits: Sequence[float]) -> DataFrame:
    """(bucket, n) for the given splits."""
    return bucketize(df, col, "bucket", splits).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def histogram_merge(df: DataFrame, goal_splits=GOAL_SPLITS, goal_log_splits=GOAL_LOG_SPLITS) -> DataFrame:
    """(bucket_idx, goal_count, goal_log_count), keyed on bucket id; a bucket
    empty in one histogram shows 0 there."""
    b = bucketize(bucketize(df, "goal", "_gb", goal_splits), "goal_log", "_lb", goal_log_splits)
    long = b.selectExpr("stack(2, 'g', _gb, 'l', _lb) AS (which, bucket_idx)")
    return long.groupBy("bucket_idx").agg(
        F.sum(F.when(F.col("which") == "g", 1).otherwise(0)).cast("long").alias("goal_count"),
        F.sum(F.when(F.col("which") == "l", 1).otherwise(0)).cast("long").alias("goal_log_count"))


def top_buckets(merged: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` fullest buckets of each histogram (ties: lower bucket first).

    Runs on the merged histogram, whose size is bounded by the split count.
    """
    long = merged.selectExpr(
        "stack(2, 'goal', bucket_idx, goal_count, 'goal_log', bucket_idx, goal_log_count) AS (histogram, bucket, n)"
    ).filter(F.col("n") > 0)
    w = Window.partitionBy("histogram").orderBy(F.col("n").desc(), F.col("bucket").asc_nulls_last())
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
