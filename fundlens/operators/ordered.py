"""Distributed running sums over a global order.

A cumulative sum over *all* rows ordered by a key is, written naively, a
``Window.orderBy`` without ``partitionBy``: Spark moves every row into one
task. Here it is done in two levels, in one lazy plan:

1. Each row's range is a function of its key alone (``key_range``), that
   never falls as the key grows: no pass over the data picks bounds.
2. Within each range a partitioned window computes the local running sum.
3. Range totals get their prefix offsets in two levels as well: ``COARSE`` neighbouring ranges
   are one coarse range, windows run within each of these and over their totals, so that no task
   reads more than about the square root of all ranges. Offsets and grand totals are joined back to the rows.

The caller passes one row per distinct key (aggregate first), so a key
holding a third of all rows is a single row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges between a key and its double. Doubles have 2,100 such steps, so there
#: are 4,300 times as many ranges at most, over all possible keys.
FINENESS = 1024
_STEPS = 1100
#: Ranges of a coarse range, as a power of two: of the 9 million ranges at most there are then some 4,400 coarse ones.
COARSE = 11


def _steps(x: Column, fineness: int) -> Column:
    """Ranges from 0 to x > 0: even ones between a power of two and the next."""
    power = F.floor(F.log2(x))
    within = F.least(F.greatest(x / F.pow(F.lit(2.0), power) - 1, F.lit(0.0)), F.lit(1.0))
    return F.when(x > 0, F.greatest(F.floor((power + within + _STEPS) * fineness), F.lit(1))).otherwise(0).cast("long")


def key_range(key: Column, fineness: int = FINENESS) -> Column:
    """The number of a key's range. Ranges are narrow near 0 and near 1, where
    probabilities crowd; larger and negative keys have ranges of their own."""
    half = 2 * _STEPS * fineness
    return (F.when(key < 0, -_steps(-key, fineness))
            .when(key <= 0.5, _steps(key, fineness))
            .when(key <= 1, F.lit(2 * half) - _steps(1 - key, fineness))
            .otherwise(F.lit(2 * half) + _steps(key, fineness)))


def running_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                 fineness: int = FINENESS, group_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in the given direction) and
    ``tot_<c>`` (grand total) for each ``c`` in ``sum_cols``, separately per
    ``group_cols`` group if given.

    ``order_col`` must be unique per row within a group, and not NULL or NaN.
    """
    k = F.col(order_col).cast("double")
    at = key_range(k, fineness)
    ranged = df.withColumn("_r", -at if descending else at)
    g = list(group_cols)
    w_in = Window.partitionBy(*g, "_r").orderBy(k.desc() if descending else k.asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(*df.columns, "_r", *[F.sum(c).over(w_in).alias(f"_l_{c}") for c in sum_cols])

    # A row for each range that has any key, and for each coarse range.
    totals = ranged.groupBy(*g, "_r").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols]).withColumn("_c", F.shiftright("_r", COARSE))
    coarse = totals.groupBy(*g, "_c").agg(*[F.sum(f"_t_{c}").alias(f"_s_{c}") for c in sum_cols])
    every = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = coarse.select(*g, "_c", *[F.coalesce(F.sum(f"_s_{c}").over(earlier(every.orderBy("_c"))), F.lit(0)).alias(f"_b_{c}")
                                       for c in sum_cols],
                           *[F.sum(f"_s_{c}").over(every).alias(f"tot_{c}") for c in sum_cols])
    inside = earlier(Window.partitionBy(*g, "_c").orderBy("_r"))
    offsets = totals.select(*g, "_c", "_r", *[F.coalesce(F.sum(f"_t_{c}").over(inside), F.lit(0)).alias(f"_i_{c}") for c in sum_cols]).join(
        before, [*g, "_c"]).select(*g, "_r", *[(F.col(f"_i_{c}") + F.col(f"_b_{c}")).alias(f"_o_{c}") for c in sum_cols],
                                   *[f"tot_{c}" for c in sum_cols])
    out = local.join(offsets, [*g, "_r"], "inner")
    return out.select(*df.columns, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sum_cols],
                      *[F.col(f"tot_{c}") for c in sum_cols])
