"""Data profile (§2.4)."""

from __future__ import annotations

from ..operators import clean as K
from ..operators import profile as P
from ..sources.campaigns import campaigns
from ..sources.schema import REQUIRED_COLUMNS
from .oracle import FEATURES_CTE, VALIDATED_CTE, bucket_sql, with_campaigns
from .q_clean import feature_table, model_table
from .registry import register

S = "profile"
VF = VALIDATED_CTE + ",\n" + FEATURES_CTE


@register("row_count", with_campaigns("SELECT COUNT(*) AS n_rows FROM campaigns"), S)
def row_count(spark, sf):
    return P.row_count(campaigns(spark, sf, ["id"]))


_np = ", ".join(
    f"COUNT(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'goal' else ''}) AS {c}"
    for c in REQUIRED_COLUMNS)


@register("null_profile", with_campaigns(f"SELECT {_np} FROM campaigns"), S)
def null_profile(spark, sf):
    return K.null_profile(model_table(spark, sf), REQUIRED_COLUMNS)


@register("class_distribution", with_campaigns("SELECT state, COUNT(*) AS n FROM validated GROUP BY state",
                                               VALIDATED_CTE), S)
def class_distribution(spark, sf):
    return P.class_distribution(K.validate(model_table(spark, sf)))


@register("distinct_counts", with_campaigns(
    "SELECT COUNT(DISTINCT country) AS n_country, COUNT(DISTINCT category) AS n_category FROM validated",
    VALIDATED_CTE), S)
def distinct_counts(spark, sf):
    return P.distinct_counts(K.validate(model_table(spark, sf)))


def _describe_sql(cols):
    parts = []
    for stat, fn in [("count", "CAST(COUNT({c}) AS DOUBLE)"), ("mean", "AVG({c})"), ("stddev", "STDDEV_SAMP({c})"),
                     ("min", "CAST(MIN({c}) AS DOUBLE)"), ("max", "CAST(MAX({c}) AS DOUBLE)")]:
        sel = ", ".join(f"ROUND(CAST({fn.format(c=c)} AS DOUBLE), 4) AS {c}" for c in cols)
        parts.append(f"SELECT '{stat}' AS statistic, {sel} FROM features")
    return "\nUNION ALL ".join(parts)


@register("describe_goal", with_campaigns(_describe_sql(["goal", "goal_log"]), VF), S)
def describe_goal(spark, sf):
    return P.describe(feature_table(spark, sf), ["goal", "goal_log"])


@register("describe_duration", with_campaigns(_describe_sql(["duration"]), VF), S)
def describe_duration(spark, sf):
    return P.describe(feature_table(spark, sf), ["duration"])


@register("goal_histogram", with_campaigns(
    f"SELECT {bucket_sql('goal', P.GOAL_SPLITS)} AS bucket, COUNT(*) AS n FROM features GROUP BY 1", VF), S)
def goal_histogram(spark, sf):
    return P.histogram(feature_table(spark, sf), "goal", P.GOAL_SPLITS)


@register("goal_log_histogram", with_campaigns(
    f"SELECT {bucket_sql('goal_log', P.GOAL_LOG_SPLITS)} AS bucket, COUNT(*) AS n FROM features GROUP BY 1", VF), S)
def goal_log_histogram(spark, sf):
    return P.histogram(feature_table(spark, sf), "goal_log", P.GOAL_LOG_SPLITS)


MERGED_SQL = f"""merged AS (
  SELECT bucket_idx, CAST(SUM(CASE WHEN which = 'g' THEN 1 ELSE 0 END) AS BIGINT) AS goal_count,
         CAST(SUM(CASE WHEN which = 'l' THEN 1 ELSE 0 END) AS BIGINT) AS goal_log_count
  FROM (SELECT 'g' AS which, {bucket_sql('goal', P.GOAL_SPLITS)} AS bucket_idx FROM features
        UNION ALL SELECT 'l', {bucket_sql('goal_log', P.GOAL_LOG_SPLITS)} FROM features) t
  GROUP BY bucket_idx)"""


@register("histogram_merge", with_campaigns("SELECT * FROM merged", VF + ",\n" + MERGED_SQL), S)
def histogram_merge(spark, sf):
    return P.histogram_merge(feature_table(spark, sf))


@register("top_buckets", with_campaigns("""
SELECT histogram, bucket, n, rank FROM (
  SELECT histogram, bucket, n,
         CAST(ROW_NUMBER() OVER (PARTITION BY histogram ORDER BY n DESC, bucket ASC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT 'goal' AS histogram, bucket_idx AS bucket, goal_count AS n FROM merged
        UNION ALL SELECT 'goal_log', bucket_idx, goal_log_count FROM merged) u
  WHERE n > 0) r
WHERE rank <= 10""", VF + ",\n" + MERGED_SQL), S)
def top_buckets(spark, sf):
    return P.top_buckets(P.histogram_merge(feature_table(spark, sf)), 10)
