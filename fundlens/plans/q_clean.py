"""Projections, validation, cleaning (§2.2) and the region join (§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import clean as K
from ..operators import enrich as E
from ..sources.campaigns import campaigns
from ..sources.schema import MODEL_COLUMNS
from .oracle import VALIDATED_CTE, with_campaigns
from .registry import register

S = "clean"
MODEL_SQL = "id, goal, category, country, launched_at, deadline, staff_pick, state"
# The creators the exclusion sheet removes.
EXCLUDED_CREATORS = ["Customer#000000001", "Customer#000000002", "Customer#000000003"]


def model_table(spark, sf):
    return campaigns(spark, sf, ["id", *MODEL_COLUMNS])


def feature_table(spark, sf):
    """Validated campaigns with duration, goal_log and integer staff_pick."""
    return K.with_features(K.validate(model_table(spark, sf)))


@register("select_model_columns", with_campaigns(f"SELECT {MODEL_SQL} FROM campaigns"), S)
def select_model_columns(spark, sf):
    return K.select_model_columns(campaigns(spark, sf), extra=["id"])


@register("validate", with_campaigns(f"SELECT {MODEL_SQL} FROM validated", VALIDATED_CTE), S)
def validate(spark, sf):
    return K.validate(model_table(spark, sf))


@register("validation_report", with_campaigns("""
SELECT COUNT(*) AS rows_before, (SELECT COUNT(*) FROM validated) AS rows_after,
       COUNT(*) - (SELECT COUNT(*) FROM validated) AS rows_dropped
FROM campaigns""", VALIDATED_CTE), S)
def validation_report(spark, sf):
    return K.validation_report(model_table(spark, sf))


_FEAT_OUT = ("id, goal, category, country, launched_at, deadline, staff_pick, state, duration, "
             "ROUND(goal_log, 6) AS goal_log")


def _feat_out(df):
    return df.select("id", "goal", "category", "country", "launched_at", "deadline", "staff_pick", "state",
                     "duration", F.round("goal_log", 6).alias("goal_log"))


@register("drop_any_null", with_campaigns(f"""
SELECT {_FEAT_OUT} FROM (
  SELECT id, goal, category, country, launched_at, deadline, CAST(staff_pick AS INTEGER) AS staff_pick, state,
         deadline - launched_at AS duration, ln(1 + goal) AS goal_log
  FROM campaigns) t
WHERE id IS NOT NULL AND goal IS NOT NULL AND category IS NOT NULL AND country IS NOT NULL
  AND launched_at IS NOT NULL AND deadline IS NOT NULL AND staff_pick IS NOT NULL AND state IS NOT NULL
  AND duration IS NOT NULL AND goal_log IS NOT NULL"""), S)
def drop_any_null(spark, sf):
    return _feat_out(K.drop_any_null(K.with_features(model_table(spark, sf))))


@register("clean_features", with_campaigns("""
SELECT COUNT(*) AS rows_before,
       COUNT(*) FILTER (WHERE goal_log IS NOT NULL AND duration IS NOT NULL AND staff_pick IS NOT NULL
                 AND category IS NOT NULL AND country IS NOT NULL AND state IS NOT NULL) AS rows_after,
       COUNT(*) FILTER (WHERE NOT (goal_log IS NOT NULL AND duration IS NOT NULL AND staff_pick IS NOT NULL
                 AND category IS NOT NULL AND country IS NOT NULL AND state IS NOT NULL)) AS rows_removed
FROM (SELECT category, country, state, CAST(staff_pick AS INTEGER) AS staff_pick,
             deadline - launched_at AS duration, ln(1 + goal) AS goal_log FROM campaigns) t"""), S)
def clean_features(spark, sf):
    return K.clean_report(K.with_features(model_table(spark, sf)))


@register("fill_missing", with_campaigns("""
SELECT id, COALESCE(deadline - launched_at, 0) AS duration, COALESCE(backers_count, 0) AS backers_count,
       COALESCE(pledged, 0.0) AS pledged, CAST(staff_pick AS INTEGER) AS staff_pick
FROM campaigns"""), S)
def fill_missing(spark, sf):
    df = campaigns(spark, sf, ["id", "launched_at", "deadline", "backers_count", "pledged", "staff_pick"])
    df = df.select("id", C.duration().alias("duration"), "backers_count", "pledged",
                   C.staff_pick_int().alias("staff_pick"))
    return K.fill_missing(df, ["duration", "backers_count", "pledged"], 0)


@register("duration", with_campaigns("SELECT id, deadline - launched_at AS duration FROM campaigns"), S)
def duration(spark, sf):
    return campaigns(spark, sf, ["id", "launched_at", "deadline"]).select("id", C.duration().alias("duration"))


@register("cast_staff_pick", with_campaigns("SELECT id, CAST(staff_pick AS INTEGER) AS staff_pick FROM campaigns"), S)
def cast_staff_pick(spark, sf):
    return campaigns(spark, sf, ["id", "staff_pick"]).select("id", C.staff_pick_int().alias("staff_pick"))


@register("negative_duration", with_campaigns(
    "SELECT COUNT(*) FILTER (WHERE deadline - launched_at < 0) AS negative_durations "
    "FROM campaigns"), S)
def negative_duration(spark, sf):
    return K.negative_duration(campaigns(spark, sf, ["launched_at", "deadline"]))


_excl = ", ".join(f"'{c}'" for c in EXCLUDED_CREATORS)


@register("exclude_members", with_campaigns(
    f"SELECT id, creator, goal FROM campaigns WHERE creator IS NULL OR creator NOT IN ({_excl})"), S)
def exclude_members(spark, sf):
    return K.exclude_members(campaigns(spark, sf, ["id", "creator", "goal"]), "creator", EXCLUDED_CREATORS)


_DQ_ONE = """one AS (
  SELECT CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS not_empty,
         COUNT(*) FILTER (WHERE goal <= 0) AS goal_non_positive,
         COUNT(*) FILTER (WHERE state NOT IN (0, 1)) AS state_not_binary,
         COUNT(*) FILTER (WHERE category IS NULL) AS null_category,
         COUNT(*) FILTER (WHERE country IS NULL) AS null_country,
         COUNT(*) FILTER (WHERE goal IS NULL) AS null_goal,
         COUNT(*) FILTER (WHERE state IS NULL) AS null_state,
         COUNT(*) FILTER (WHERE goal > -1 AND goal < 0) AS goal_log_negative,
         COUNT(*) FILTER (WHERE deadline - launched_at IS NULL OR goal IS NULL OR goal <= -1)
           AS null_duration_or_goal_log
  FROM campaigns)"""
_DQ_BODY = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"check\", {c} AS violations, {c} = 0 AS passed FROM one" for c in K.DQ_CHECKS)


@register("dq_checks", with_campaigns(_DQ_BODY, _DQ_ONE), S)
def dq_checks(spark, sf):
    return K.dq_checks(campaigns(spark, sf, ["category", "country", "goal", "state", "launched_at", "deadline"]))


# ---- joins (§2.3) ---------------------------------------------------------------

LOOKUP_SQL = """lookup AS (
  SELECT n.n_name AS country, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("region_lookup", with_campaigns("SELECT country, region FROM lookup", LOOKUP_SQL), "join")
def region_lookup(spark, sf):
    return E.region_lookup(spark, sf)


@register("region_enrich", with_campaigns(
    "SELECT c.id, c.country, l.region FROM campaigns c LEFT JOIN lookup l ON c.country = l.country",
    LOOKUP_SQL), "join")
def region_enrich(spark, sf):
    df = campaigns(spark, sf, ["id", "country"])
    return E.region_enrich(df, E.region_lookup(spark, sf)).select("id", "country", "region")


@register("unmapped_countries", with_campaigns("""
SELECT c.country, COUNT(*) AS n_campaigns FROM campaigns c
WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.country = c.country)
GROUP BY c.country""", LOOKUP_SQL), "join")
def unmapped_countries(spark, sf):
    return E.unmapped_countries(campaigns(spark, sf, ["country"]), E.region_lookup(spark, sf))
