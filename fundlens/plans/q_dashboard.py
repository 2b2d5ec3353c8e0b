"""Dashboard measures (§2.5), top-N views (§2.7) and row-level fields (§2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cube as CU
from ..operators import dashboard as D
from ..session import scratch_path
from ..sources.campaigns import campaigns
from .oracle import (COMPLETENESS, CREATED_MONTH, DURATION_DAYS, FUNDING_PCT, GOAL_TIER,
                     OVERFUNDED, SUCCESS_FLAG, SUCCESS_RATE, with_campaigns)
from .registry import register

S = "dashboard"


def _kpi(key, cols, sql_expr):
    register(key, with_campaigns(f"SELECT {sql_expr} AS {key[4:]} FROM campaigns"), S)(
        lambda spark, sf: D.kpi(campaigns(spark, sf, cols), key[4:]))


_kpi("kpi_total_records", ["id"], "COUNT(id)")
_kpi("kpi_missing_blurb", ["id", "blurb"],
     "ROUND(CAST(SUM(CASE WHEN blurb IS NULL OR blurb = '' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) AS DOUBLE), 6)")
_kpi("kpi_missing_goal", ["id", "goal"],
     "ROUND(CAST(SUM(CASE WHEN goal IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) AS DOUBLE), 6)")
_kpi("kpi_completeness", ["id", "blurb", "goal", "category"], COMPLETENESS)
_kpi("kpi_missing_data", ["id", "blurb", "goal"],
     "CAST(SUM(CASE WHEN blurb IS NULL OR goal IS NULL THEN 1 ELSE 0 END) AS BIGINT)")
_kpi("kpi_countries_covered", ["country"], "COUNT(DISTINCT country)")
_kpi("kpi_success_rate", ["id", "state"], SUCCESS_RATE)
_kpi("kpi_avg_funding", ["pledged", "goal"], f"ROUND(AVG({FUNDING_PCT}), 6)")
_kpi("kpi_avg_backers", ["backers_count"], "ROUND(AVG(backers_count), 6)")


@register("kpi_dashboard", with_campaigns(f"""
SELECT COUNT(id) AS total_records,
       ROUND(CAST(SUM(CASE WHEN blurb IS NULL OR blurb = '' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) AS DOUBLE), 6) AS missing_blurb,
       ROUND(CAST(SUM(CASE WHEN goal IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(id) AS DOUBLE), 6) AS missing_goal,
       {COMPLETENESS} AS completeness,
       CAST(SUM(CASE WHEN blurb IS NULL OR goal IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_data,
       COUNT(DISTINCT country) AS countries_covered,
       {SUCCESS_RATE} AS success_rate,
       ROUND(AVG({FUNDING_PCT}), 6) AS avg_funding,
       ROUND(AVG(backers_count), 6) AS avg_backers
FROM campaigns"""), S)
def kpi_dashboard(spark, sf):
    """All KPI tiles of the campaign dashboard in one pass over the table."""
    return D.kpi(campaigns(spark, sf))


@register("success_by_category", with_campaigns(f"""
SELECT category, COUNT(id) AS n_campaigns, {SUCCESS_RATE} AS success_rate
FROM campaigns GROUP BY category"""), S)
def success_by_category(spark, sf):
    return D.success_by_category(campaigns(spark, sf, ["id", "category", "state"]))


@register("efficiency_by_category", with_campaigns("""
SELECT category, ROUND(AVG(backers_count), 6) AS avg_backers,
       ROUND(CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(pledged), 6) AS avg_pledged
FROM campaigns GROUP BY category"""), S)
def efficiency_by_category(spark, sf):
    return D.efficiency_by_category(campaigns(spark, sf, ["category", "backers_count", "pledged"]))


@register("scalability_by_category", with_campaigns("""
SELECT category,
       ROUND((CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) / CAST(SUM(CAST(goal AS DECIMAL(18, 2))) AS DOUBLE)) * 40 + AVG(backers_count) / 10 * 20 + 40, 6) AS scalability_index
FROM campaigns GROUP BY category"""), S)
def scalability_by_category(spark, sf):
    return D.scalability_by_category(campaigns(spark, sf, ["category", "pledged", "goal", "backers_count"]))


@register("funding_by_outcome", with_campaigns(f"""
SELECT {SUCCESS_FLAG} AS success_flag, ROUND(SUM({FUNDING_PCT}), 6) AS funding_pct_sum
FROM campaigns GROUP BY 1"""), S)
def funding_by_outcome(spark, sf):
    return D.funding_by_outcome(campaigns(spark, sf, ["state", "pledged", "goal"]))


@register("backers_vs_pledged_by_outcome", with_campaigns(f"""
SELECT {SUCCESS_FLAG} AS success_flag, CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) AS sum_pledged,
       CAST(SUM(backers_count) AS BIGINT) AS sum_backers, CAST(SUM(CAST(goal AS DECIMAL(18, 2))) AS DOUBLE) AS sum_goal
FROM campaigns GROUP BY 1"""), S)
def backers_vs_pledged_by_outcome(spark, sf):
    return D.backers_vs_pledged_by_outcome(campaigns(spark, sf, ["state", "pledged", "backers_count", "goal"]))


@register("volume_by_month", with_campaigns(f"""
SELECT {CREATED_MONTH} AS created_month, COUNT(id) AS n_campaigns FROM campaigns GROUP BY 1"""), S)
def volume_by_month(spark, sf):
    return D.volume_by_month(campaigns(spark, sf, ["id", "created_at"]))


@register("volume_by_year", with_campaigns(f"""
SELECT CAST(year({CREATED_MONTH}) AS INTEGER) AS created_year, COUNT(id) AS n_campaigns
FROM campaigns GROUP BY 1"""), S)
def volume_by_year(spark, sf):
    return D.volume_by_year(campaigns(spark, sf, ["id", "created_at"]))


@register("rate_by_goal_count", with_campaigns(f"""
SELECT id, {SUCCESS_RATE} AS success_rate, COUNT(goal) AS goal_count FROM campaigns GROUP BY id"""), S)
def rate_by_goal_count(spark, sf):
    return D.rate_by_goal_count(campaigns(spark, sf, ["id", "state", "goal"]))


@register("goal_tier_summary", with_campaigns(f"""
SELECT {GOAL_TIER} AS goal_tier, COUNT(id) AS n_campaigns, {SUCCESS_RATE} AS success_rate
FROM campaigns GROUP BY 1"""), S)
def goal_tier_summary(spark, sf):
    return D.goal_tier_summary(campaigns(spark, sf, ["id", "goal", "state"]))


@register("overfunded_summary", with_campaigns(f"""
SELECT {OVERFUNDED} AS overfunded_flag, COUNT(id) AS n_campaigns FROM campaigns GROUP BY 1"""), S)
def overfunded_summary(spark, sf):
    return D.overfunded_summary(campaigns(spark, sf, ["id", "pledged", "goal"]))


# ---- top-N ----------------------------------------------------------------------

@register("top10_funded", with_campaigns("""
SELECT name, ROUND(AVG(backers_count), 6) AS avg_backers, CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) AS sum_pledged
FROM campaigns GROUP BY name
ORDER BY avg_backers DESC NULLS LAST, name ASC NULLS LAST LIMIT 10"""), "topk")
def top10_funded(spark, sf):
    return D.top_funded(campaigns(spark, sf, ["name", "backers_count", "pledged"]), 10)


@register("top10_scatter", with_campaigns("""
SELECT name, ROUND(AVG(backers_count), 6) AS avg_backers, CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) AS sum_pledged,
       CAST(SUM(backers_count) AS BIGINT) AS sum_backers, CAST(SUM(CAST(goal AS DECIMAL(18, 2))) AS DOUBLE) AS sum_goal,
       CAST(SUM(state) AS BIGINT) AS sum_state
FROM campaigns GROUP BY name
ORDER BY avg_backers DESC NULLS LAST, name ASC NULLS LAST LIMIT 10"""), "topk")
def top10_scatter(spark, sf):
    return D.top_scatter(campaigns(spark, sf, ["name", "backers_count", "pledged", "goal", "state"]), 10)


@register("top10_blurb_completeness", with_campaigns(f"""
SELECT blurb, {COMPLETENESS} AS completeness
FROM campaigns GROUP BY blurb
ORDER BY completeness DESC NULLS LAST, blurb ASC NULLS LAST LIMIT 10"""), "topk")
def top10_blurb_completeness(spark, sf):
    return D.top_blurb_completeness(campaigns(spark, sf, ["id", "blurb", "goal", "category"]), 10)


# ---- row-level fields (§2.9) -----------------------------------------------------

@register("goal_log", with_campaigns("SELECT id, ROUND(ln(1 + goal), 6) AS goal_log FROM campaigns"), "scalar")
def goal_log(spark, sf):
    return campaigns(spark, sf, ["id", "goal"]).select("id", F.round(C.goal_log(), 6).alias("goal_log"))


@register("funding_pct", with_campaigns(f"SELECT id, ROUND({FUNDING_PCT}, 6) AS funding_pct FROM campaigns"), "scalar")
def funding_pct(spark, sf):
    return campaigns(spark, sf, ["id", "pledged", "goal"]).select(
        "id", F.round(C.funding_pct(), 6).alias("funding_pct"))


@register("overfunded_flag", with_campaigns(f"SELECT id, {OVERFUNDED} AS overfunded_flag FROM campaigns"), "scalar")
def overfunded_flag(spark, sf):
    return campaigns(spark, sf, ["id", "pledged", "goal"]).select("id", C.overfunded_flag().alias("overfunded_flag"))


@register("success_flag", with_campaigns(f"SELECT id, {SUCCESS_FLAG} AS success_flag FROM campaigns"), "scalar")
def success_flag(spark, sf):
    return campaigns(spark, sf, ["id", "state"]).select("id", C.success_flag().alias("success_flag"))


@register("goal_tier", with_campaigns(f"SELECT id, {GOAL_TIER} AS goal_tier FROM campaigns"), "scalar")
def goal_tier(spark, sf):
    return campaigns(spark, sf, ["id", "goal"]).select("id", C.goal_tier().alias("goal_tier"))


@register("duration_days", with_campaigns(f"SELECT id, {DURATION_DAYS} AS duration_days FROM campaigns"), "scalar")
def duration_days(spark, sf):
    return campaigns(spark, sf, ["id", "launched_at", "deadline"]).select(
        "id", C.duration_days().alias("duration_days"))


@register("backers_per_day", with_campaigns(f"""
SELECT id, ROUND(CAST(backers_count AS DOUBLE) / NULLIF(CAST({DURATION_DAYS} AS DOUBLE), 0), 6) AS backers_per_day
FROM campaigns"""), "scalar")
def backers_per_day(spark, sf):
    return campaigns(spark, sf, ["id", "backers_count", "launched_at", "deadline"]).select(
        "id", F.round(C.backers_per_day(), 6).alias("backers_per_day"))


@register("created_month", with_campaigns(f"SELECT id, {CREATED_MONTH} AS created_month FROM campaigns"), "scalar")
def created_month(spark, sf):
    return campaigns(spark, sf, ["id", "created_at"]).select("id", C.created_month().alias("created_month"))


@register("rounding", with_campaigns(f"""
SELECT category, ROUND(AVG({FUNDING_PCT}), 4) AS avg_funding_pct, ROUND(AVG({DURATION_DAYS}), 2) AS avg_duration_days
FROM campaigns GROUP BY category"""), "scalar")
def rounding(spark, sf):
    """Report rounding: ratios to 4 decimals, times to 2."""
    df = campaigns(spark, sf, ["category", "pledged", "goal", "launched_at", "deadline"])
    return df.groupBy("category").agg(C.rounded(F.avg(C.funding_pct()), 4).alias("avg_funding_pct"),
                                      C.rounded(F.avg(C.duration_days()), 2).alias("avg_duration_days"))


LIMIT_ROWS = 5000


@register("limit_rows", with_campaigns(
    f"SELECT id, goal, category, country, state FROM campaigns ORDER BY id LIMIT {LIMIT_ROWS}"), "topk")
def limit_rows(spark, sf):
    """Repeatable quick slice: the first rows by id (a top-k, not a full sort)."""
    return campaigns(spark, sf, ["id", "goal", "category", "country", "state"]).orderBy("id").limit(LIMIT_ROWS)


_CUBE_COLUMNS = ["id", "category", "country", "created_at", "state", "blurb", "goal", "pledged", "backers_count", "name"]


def cube_cells(spark, sf):
    """The cube, written and read as a table of its own."""
    path = scratch_path(spark, "cube")
    CU.summary_cube(campaigns(spark, sf, _CUBE_COLUMNS)).write.parquet(path)
    return spark.read.parquet(path)


@register("summary_cube", with_campaigns(f"""
SELECT category, country, {CREATED_MONTH} AS created_month, state, COUNT(*) AS n_rows, COUNT(id) AS n_ids,
       COUNT(*) FILTER (WHERE blurb IS NULL OR blurb = '') AS blank_blurbs, COUNT(*) FILTER (WHERE blurb IS NULL) AS null_blurbs,
       COUNT(*) FILTER (WHERE goal IS NULL) AS null_goals, COUNT(*) FILTER (WHERE blurb IS NULL OR goal IS NULL) AS incomplete,
       CAST(SUM(backers_count) AS BIGINT) AS backers, COUNT(backers_count) AS n_backers,
       CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) AS pledged, COUNT(pledged) AS n_pledged,
       CAST(SUM(CAST(goal AS DECIMAL(18, 2))) AS DOUBLE) AS goal, COUNT(goal) AS n_goals
FROM campaigns GROUP BY 1, 2, 3, 4"""), S)
def summary_cube(spark, sf):
    return cube_cells(spark, sf).drop("names").withColumns({c: F.col(c).cast("double") for c in ("pledged", "goal")})


@register("cube_by_category", with_campaigns(f"""
SELECT category, COUNT(id) AS n_campaigns, {SUCCESS_RATE} AS success_rate, ROUND(AVG(backers_count), 6) AS avg_backers,
       ROUND(CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(pledged), 6) AS avg_pledged,
       ROUND((CAST(SUM(CAST(pledged AS DECIMAL(18, 2))) AS DOUBLE) / CAST(SUM(CAST(goal AS DECIMAL(18, 2))) AS DOUBLE)) * 40
             + AVG(backers_count) / 10 * 20 + 40, 6) AS scalability_index
FROM campaigns GROUP BY category"""), S)
def cube_by_category(spark, sf):
    """The category measures from the cube's cells instead of the rows."""
    return CU.by_category(cube_cells(spark, sf))
