"""Cleaning, validation and data-quality operators.

Counts that the reference gathers with one job per statistic are folded into
a single aggregation pass here (``validation_report``, ``dq_checks``,
``null_profile``): one scan, partial aggregation per task, one-row result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import duration, goal_log, staff_pick_int
from ..sources.schema import DEFAULT_NOT_NULL, MODEL_COLUMNS, REQUIRED_COLUMNS

FEATURE_NOT_NULL = ["goal_log", "duration", "staff_pick", "category", "country", "state"]


def _count_if(cond: Column) -> Column:
    return F.count_if(cond)  # 0, not NULL, on no rows


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def select_model_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*extra, *MODEL_COLUMNS)


def _as_double(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` AS DOUBLE)")


def _as_int(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` AS INT)")


def validation_predicate(required: Sequence[str] = DEFAULT_NOT_NULL) -> Column:
    """Row passes: goal > 0, state in (0, 1), required columns not null.

    ``try_cast`` keeps malformed strings (CSV input) from failing the task
    under ANSI mode; they simply fail the rule.
    """
    cond = (_as_double("goal") > 0) & _as_int("state").isin(0, 1)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    # A NULL outcome already fails both `filter` and `when`; leaving the
    # conjunction bare lets each conjunct reach the Parquet scan as a
    # pushed filter.
    return cond


def validate(df: DataFrame, required: Sequence[str] = DEFAULT_NOT_NULL) -> DataFrame:
    return df.filter(validation_predicate(required))


def validation_report(df: DataFrame, required: Sequence[str] = DEFAULT_NOT_NULL,
                      extra: Sequence[Column] = ()) -> DataFrame:
    """rows_before, rows_after, rows_dropped (and ``extra`` aggregates) in one pass."""
    ok = validation_predicate(required)
    return df.agg(F.count(F.lit(1)).alias("rows_before"), _count_if(ok).alias("rows_after"), *extra) \
        .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def with_features(df: DataFrame) -> DataFrame:
    """duration (seconds), goal_log and integer staff_pick."""
    return (df.withColumn("duration", duration())
              .withColumn("goal_log", goal_log())
              .withColumn("staff_pick", staff_pick_int()))


def clean_features(df: DataFrame, subset: Sequence[str] = FEATURE_NOT_NULL) -> DataFrame:
    return df.dropna(subset=list(subset))


def clean_report(df: DataFrame, subset: Sequence[str] = FEATURE_NOT_NULL) -> DataFrame:
    keep = F.lit(True)
    for c in subset:
        keep = keep & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows_before"), _count_if(keep).alias("rows_after")) \
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def fill_missing(df: DataFrame, subset: Sequence[str], value=0) -> DataFrame:
    return df.fillna(value, subset=list(subset))


def negative_duration(df: DataFrame) -> DataFrame:
    d = F.col("duration") if "duration" in df.columns else duration()
    return df.agg(_count_if(d < 0).alias("negative_durations"))


def exclude_members(df: DataFrame, col: str, values: Sequence, max_literal: int = 10_000) -> DataFrame:
    """Drop rows whose ``col`` is in ``values``; NULL members are kept, and a
    NULL in the list excludes nothing; an empty set keeps everything.

    Short lists become an IN predicate (pushed into the scan's filter); long
    lists become a left-anti join, where Spark decides on broadcast from the
    list's measured size. The rows are the same either way.
    """
    values = [v for v in values if v is not None]
    if not values:
        return df
    if len(values) <= max_literal:
        return df.filter(F.col(col).isNull() | ~F.col(col).isin(values))
    spark = df.sparkSession
    dtype = df.schema[col].dataType
    excl = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(col, dtype)]))
    return df.join(excl, on=col, how="left_anti")


def null_profile(df: DataFrame, cols: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One row: per column, NULLs (and NaN for floating columns).

    Dispatches on the dtype: ``isnan`` is only applied where it is defined.
    """
    types = dict(df.dtypes)
    aggs = []
    for c in cols:
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(c)
        aggs.append(_count_if(cond).alias(c))
    return df.agg(*aggs)


DQ_CHECKS = [
    "not_empty", "goal_non_positive", "state_not_binary", "null_category", "null_country",
    "null_goal", "null_state", "goal_log_negative", "null_duration_or_goal_log",
]


def dq_checks(df: DataFrame) -> DataFrame:
    """(check, violations, passed) for the data and feature test suite, one pass.

    Missing required columns fail before any job runs.
    """
    require_columns(df, ["category", "country", "goal", "state"])
    if "duration" not in df.columns or "goal_log" not in df.columns:
        require_columns(df, ["launched_at", "deadline"])
        df = df.withColumn("duration", duration()).withColumn("goal_log", goal_log())
    one = df.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("not_empty"),
        _count_if(F.col("goal") <= 0).alias("goal_non_positive"),
        _count_if(~F.col("state").isin(0, 1)).alias("state_not_binary"),
        _count_if(F.col("category").isNull()).alias("null_category"),
        _count_if(F.col("country").isNull()).alias("null_country"),
        _count_if(F.col("goal").isNull()).alias("null_goal"),
        _count_if(F.col("state").isNull()).alias("null_state"),
        _count_if(F.col("goal_log") < 0).alias("goal_log_negative"),
        _count_if(F.col("duration").isNull() | F.col("goal_log").isNull()).alias("null_duration_or_goal_log"),
    )
    stack = ", ".join(f"'{c}', `{c}`" for c in DQ_CHECKS)
    return one.selectExpr(f"stack({len(DQ_CHECKS)}, {stack}) AS (check, violations)") \
        .withColumn("passed", F.col("violations") == 0)
