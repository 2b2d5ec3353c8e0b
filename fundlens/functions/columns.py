"""Row-level campaign measures as Spark Column expressions.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen. Ratios use ``try_divide`` so a zero or NULL denominator yields NULL
under ANSI mode instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "goal_log", "funding_pct", "overfunded_flag", "success_flag", "goal_tier",
    "duration", "duration_days", "backers_per_day", "created_month", "staff_pick_int",
    "prob_pos", "rounded", "epoch_day", "GOAL_TIER_BOUNDS", "GOAL_TIER_LABELS",
]

SECONDS_PER_DAY = 86400

# Goal tier upper bounds (exclusive) and their labels, lowest first.
GOAL_TIER_BOUNDS = [1000, 5000, 10000, 50000]
GOAL_TIER_LABELS = ["< $1K", "$1K-$5K", "$5K-$10K", "$10K-$50K", "$50K+"]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def goal_log(c="goal") -> Column:
    """log(1 + goal)."""
    return F.log1p(col_of(c))


def funding_pct(pledged="pledged", goal="goal") -> Column:
    """pledged / goal, NULL when goal is 0 or either side is NULL."""
    return F.try_divide(col_of(pledged), col_of(goal))


def overfunded_flag(pledged="pledged", goal="goal") -> Column:
    # NULL ratio falls into the ELSE branch, as in the dashboard formula.
    return F.when(funding_pct(pledged, goal) > 1, F.lit("Overfunded")).otherwise(F.lit("Underfunded"))


def success_flag(state="state") -> Column:
    return F.when(col_of(state) == 1, F.lit("Successful")).otherwise(F.lit("Failed"))


def goal_tier(goal="goal") -> Column:
    """Five goal tiers; NULL goal lands in the last (ELSE) tier."""
    g = col_of(goal)
    expr = None
    for bound, label in zip(GOAL_TIER_BOUNDS, GOAL_TIER_LABELS):
        expr = F.when(g < bound, F.lit(label)) if expr is None else expr.when(g < bound, F.lit(label))
    return expr.otherwise(F.lit(GOAL_TIER_LABELS[-1]))


def duration(launched="launched_at", deadline="deadline") -> Column:
    """Campaign length in seconds."""
    return col_of(deadline) - col_of(launched)


def epoch_day(c) -> Column:
    """UTC day number of an epoch-second value (floor division, session-TZ free)."""
    return F.floor(col_of(c) / F.lit(SECONDS_PER_DAY))


def duration_days(launched="launched_at", deadline="deadline") -> Column:
    """Number of UTC day boundaries crossed between two epoch-second times."""
    return (epoch_day(deadline) - epoch_day(launched)).cast("long")


def backers_per_day(backers="backers_count", launched="launched_at", deadline="deadline") -> Column:
    return F.try_divide(col_of(backers).cast("double"), duration_days(launched, deadline).cast("double"))


def created_month(created="created_at") -> Column:
    """First day of the UTC month of an epoch-second value, as DATE."""
    return F.trunc(F.date_from_unix_date(epoch_day(created).cast("int")), "MM")


def staff_pick_int(c="staff_pick") -> Column:
    return col_of(c).cast("int")


def prob_pos(c="probability") -> Column:
    """Probability of the positive class from an ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(col_of(c))[1]


def rounded(c, digits: int = 4) -> Column:
    return F.round(col_of(c), digits)
