"""Dashboard measures: KPIs, grouped measures and top-N views.

Each function takes a campaigns DataFrame and returns the aggregated table.
All are single hash aggregations (partial aggregation map-side, one shuffle
on the grouping key; a global KPI is one shuffle-free partial + one-row final).
Hot keys are harmless: the partial aggregate collapses them before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (created_month, funding_pct, goal_tier, overfunded_flag,
                                 success_flag)

RATE_DIGITS = 6
MONEY_DIGITS = 2


def _rate(num: Column, den: Column) -> Column:
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), RATE_DIGITS)


def _flag_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


# ---- building blocks (aggregate Column expressions) -------------------------

def total_records() -> Column:
    return F.count("id")


def missing_blurb() -> Column:
    return _rate(_flag_sum(F.col("blurb").isNull() | (F.col("blurb") == "")), total_records())


def missing_goal() -> Column:
    return _rate(_flag_sum(F.col("goal").isNull()), total_records())


def completeness() -> Column:
    nulls = (_flag_sum(F.col("blurb").isNull()) + _flag_sum(F.col("goal").isNull())
             + _flag_sum(F.col("category").isNull()))
    return F.round(F.lit(1.0) - F.try_divide(nulls.cast("double"), (total_records() * 3).cast("double")),
                   RATE_DIGITS)


def missing_data() -> Column:
    return _flag_sum(F.col("blurb").isNull() | F.col("goal").isNull())


def countries_covered() -> Column:
    return F.count_distinct("country")


def success_rate() -> Column:
    return _rate(_flag_sum(F.col("state") == 1), total_records())


def avg_funding_pct() -> Column:
    return F.round(F.avg(funding_pct()), RATE_DIGITS)


def avg_backers() -> Column:
    return F.round(F.avg("backers_count"), RATE_DIGITS)


def scalability_index() -> Column:
    ratio = F.try_divide(money_sum("pledged"), money_sum("goal"))
    return F.round(ratio * 40 + F.avg("backers_count") / 10 * 20 + 40, RATE_DIGITS)


KPI_MEASURES = {
    "total_records": total_records,
    "missing_blurb": missing_blurb,
    "missing_goal": missing_goal,
    "completeness": completeness,
    "missing_data": missing_data,
    "countries_covered": countries_covered,
    "success_rate": success_rate,
    "avg_funding": avg_funding_pct,
    "avg_backers": avg_backers,
}


def kpi(df: DataFrame, *names: str) -> DataFrame:
    """One-row table of the named KPIs, computed in a single pass."""
    names = names or tuple(KPI_MEASURES)
    return df.agg(*[KPI_MEASURES[n]().alias(n) for n in names])


# ---- grouped measures --------------------------------------------------------

def success_by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(total_records().alias("n_campaigns"),
                                      success_rate().alias("success_rate"))


def efficiency_by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(avg_backers().alias("avg_backers"),
                                      money_avg("pledged").alias("avg_pledged"))


def money(col: str) -> Column:
    """An amount in cents, exactly; NULL where it is none."""
    return F.expr(f"try_cast(`{col}` AS DECIMAL(18, {MONEY_DIGITS}))")


def money_sum(col: str) -> Column:
    """The exact sum of amounts in cents, the same in whatever order they are added."""
    return F.sum(money(col)).cast("double")


def money_avg(col: str) -> Column:
    """The exact sum by the number of amounts."""
    return F.round(F.try_divide(money_sum(col), F.count(money(col)).cast("double")), RATE_DIGITS)


def scalability_by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(scalability_index().alias("scalability_index"))


def funding_by_outcome(df: DataFrame) -> DataFrame:
    return df.groupBy(success_flag().alias("success_flag")).agg(
        F.round(F.sum(funding_pct()), RATE_DIGITS).alias("funding_pct_sum"))


def backers_vs_pledged_by_outcome(df: DataFrame) -> DataFrame:
    return df.groupBy(success_flag().alias("success_flag")).agg(
        money_sum("pledged").alias("sum_pledged"),
        F.sum("backers_count").cast("long").alias("sum_backers"),
        money_sum("goal").alias("sum_goal"))


def volume_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(created_month().alias("created_month")).agg(total_records().alias("n_campaigns"))


def volume_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy(F.year(created_month()).alias("created_year")).agg(
        total_records().alias("n_campaigns"))


def rate_by_goal_count(df: DataFrame) -> DataFrame:
    """The scatter sheet: one mark per id with its success rate and goal count."""
    return df.groupBy("id").agg(success_rate().alias("success_rate"),
                                F.count("goal").alias("goal_count"))


def goal_tier_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(goal_tier().alias("goal_tier")).agg(total_records().alias("n_campaigns"),
                                                          success_rate().alias("success_rate"))


def overfunded_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(overfunded_flag().alias("overfunded_flag")).agg(
        total_records().alias("n_campaigns"))


# ---- top-N views ---------------------------------------------------------------

def _top_n(grouped: DataFrame, rank_col: str, dim: str, n: int) -> DataFrame:
    # orderBy + limit plans as TakeOrderedAndProject: a per-partition top-n and
    # one n-row merge, never a full sort. The dimension breaks ties so the
    # member set is deterministic.
    return grouped.orderBy(F.col(rank_col).desc_nulls_last(), F.col(dim).asc_nulls_last()).limit(n)


def top_funded(df: DataFrame, n: int = 10, by: str = "backers") -> DataFrame:
    """Top names ranked by AVG(backers_count) (the dashboard's rule) or SUM(pledged)."""
    g = df.groupBy("name").agg(avg_backers().alias("avg_backers"),
                               money_sum("pledged").alias("sum_pledged"))
    return _top_n(g, "avg_backers" if by == "backers" else "sum_pledged", "name", n)


def top_scatter(df: DataFrame, n: int = 10) -> DataFrame:
    g = df.groupBy("name").agg(
        avg_backers().alias("avg_backers"),
        money_sum("pledged").alias("sum_pledged"),
        F.sum("backers_count").cast("long").alias("sum_backers"),
        money_sum("goal").alias("sum_goal"),
        F.sum("state").cast("long").alias("sum_state"))
    return _top_n(g, "avg_backers", "name", n)


def top_blurb_completeness(df: DataFrame, n: int = 10, prefix: int = 64) -> DataFrame:
    """Most complete blurbs, ties by text.

    Blurbs are grouped by a 256-bit digest and their first characters. Only
    the texts of groups that reach the n-th rank by completeness and those
    characters (``n`` rows on the driver) are fetched and ordered in full.
    """
    keyed = df.withColumn("_digest", F.sha2("blurb", 256)).withColumn("_start", F.substring("blurb", 1, prefix))
    groups = keyed.groupBy("_digest", "_start").agg(completeness().alias("completeness"))
    top = _top_n(groups, "completeness", "_start", n).collect()
    if not top:
        return groups.select(F.col("_start").alias("blurb"), "completeness")
    last, start = top[-1]["completeness"], top[-1]["_start"]
    score = F.col("completeness")
    above = score.isNotNull() if last is None else score > F.lit(last)
    within = F.lit(True) if start is None else F.col("_start") <= F.lit(start)
    reached = groups.filter(above | (score.eqNullSafe(F.lit(last)) & within))
    texts = keyed.filter(F.col("_digest").isNotNull()).select("_digest", "blurb")
    found = (texts.join(reached.select("_digest", "completeness"), "_digest").groupBy("_digest", "completeness")
             .agg(F.first("blurb").alias("blurb")).select("blurb", "completeness"))
    null_group = reached.filter(F.col("_digest").isNull()).select(F.col("_digest").alias("blurb"), "completeness")
    return _top_n(found.unionByName(null_group), "completeness", "blurb", n)
