"""A summary cube with mergeable states, and the dashboard's additive measures from it.

A cell is a category, country, month of creation and state; it holds counts, sums of whole numbers, sums of money as
DECIMAL cents and a sketch of the names. All of these add up (the sketch by its union), so any coarser table
follows from the cells without the rows: they are as many as the dimensions have combinations, whatever the number of
rows. Cells of new rows can be stacked on those of old ones (``merged``).

Measures that are quotients of single rows (funding percentages) are not additive and stay with ``dashboard``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import created_month, success_flag
from .dashboard import RATE_DIGITS, money

DIMENSIONS = ["category", "country", "created_month", "state"]
#: Logarithm of a sketch's registers; the relative error is about 1.04 over their square root.
SKETCH_BITS = 12
_SUMS = ["n_rows", "n_ids", "blank_blurbs", "null_blurbs", "null_goals", "incomplete", "backers", "n_backers", "pledged", "n_pledged",
         "goal", "n_goals"]


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def summary_cube(df: DataFrame) -> DataFrame:
    """A row for each cell: DIMENSIONS, counts, sums, and the sketch ``names``."""
    blurb, goal = F.col("blurb"), F.col("goal")
    return df.groupBy("category", "country", created_month().alias("created_month"), "state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_ids"),
        _count_if(blurb.isNull() | (blurb == "")).alias("blank_blurbs"), _count_if(blurb.isNull()).alias("null_blurbs"),
        _count_if(goal.isNull()).alias("null_goals"), _count_if(blurb.isNull() | goal.isNull()).alias("incomplete"),
        F.sum(F.col("backers_count").cast("long")).alias("backers"), F.count("backers_count").alias("n_backers"),
        F.sum(money("pledged")).alias("pledged"), F.count(money("pledged")).alias("n_pledged"),
        F.sum(money("goal")).alias("goal"), F.count(money("goal")).alias("n_goals"),
        F.hll_sketch_agg("name", SKETCH_BITS).alias("names"))


def merged(cells: DataFrame, by: list[str | Column] = ()) -> DataFrame:
    """Cells added up by some of their dimensions (or columns made of them); all of DIMENSIONS merges stacked cubes."""
    return cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _SUMS], F.hll_union_agg("names").alias("names"))


def _rate(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), RATE_DIGITS)


def kpis(cells: DataFrame) -> DataFrame:
    """The dashboard's KPI tiles but avg_funding, in one row, with the estimated number of names."""
    total = F.sum("n_ids")
    nulls = F.sum("null_blurbs") + F.sum("null_goals") + F.sum(F.when(F.col("category").isNull(), F.col("n_rows")).otherwise(0))
    return cells.agg(
        total.alias("total_records"), _rate(F.sum("blank_blurbs"), total).alias("missing_blurb"),
        _rate(F.sum("null_goals"), total).alias("missing_goal"),
        F.round(F.lit(1.0) - F.try_divide(nulls.cast("double"), (total * 3).cast("double")), RATE_DIGITS).alias("completeness"),
        F.sum("incomplete").alias("missing_data"), F.count_distinct("country").alias("countries_covered"),
        _rate(F.sum(F.when(F.col("state") == 1, F.col("n_rows")).otherwise(0)), total).alias("success_rate"),
        _rate(F.sum("backers"), F.sum("n_backers")).alias("avg_backers"),
        F.hll_sketch_estimate(F.hll_union_agg("names")).alias("names_estimate"))


def by_category(cells: DataFrame) -> DataFrame:
    """n_campaigns, success_rate, avg_backers, avg_pledged and scalability_index of each category."""
    won = F.sum(F.when(F.col("state") == 1, F.col("n_rows")).otherwise(0))
    backers = F.try_divide(F.sum("backers").cast("double"), F.sum("n_backers").cast("double"))
    ratio = F.try_divide(F.sum("pledged").cast("double"), F.sum("goal").cast("double"))
    return cells.groupBy("category").agg(
        F.sum("n_ids").alias("n_campaigns"), _rate(won, F.sum("n_ids")).alias("success_rate"),
        F.round(backers, RATE_DIGITS).alias("avg_backers"), _rate(F.sum("pledged"), F.sum("n_pledged")).alias("avg_pledged"),
        F.round(ratio * 40 + backers / 10 * 20 + 40, RATE_DIGITS).alias("scalability_index"))


def by_outcome(cells: DataFrame) -> DataFrame:
    return cells.groupBy(success_flag().alias("success_flag")).agg(
        F.sum("pledged").cast("double").alias("sum_pledged"), F.sum("backers").alias("sum_backers"),
        F.sum("goal").cast("double").alias("sum_goal"))


def by_month(cells: DataFrame) -> DataFrame:
    return cells.groupBy("created_month").agg(F.sum("n_ids").alias("n_campaigns"))
