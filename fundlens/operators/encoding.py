"""Dictionary encoding of string columns whose labels may be many.

The codes are those of an indexer (frequency descending, then value
ascending; or value ascending), but no label list is ever on the driver:

1. Values are counted (partial counts first), a row for each label.
2. Labels are range-partitioned and sorted by the order wanted and written with their place in their range.
   Running totals of the ranges, a number for each of the shuffle's partitions, turn places into ranks.
3. The ranks are joined back. A dictionary is broadcast only if its measured size
   is below ``MAX_BROADCAST`` bytes; else it is a shuffle join, whose hot values AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of a dictionary (values and 16 for each row) that is broadcast.
MAX_BROADCAST = 32 << 20
ORDERS = ("frequencyDesc", "alphabetAsc")
_PLACE_BITS = 33  # of monotonically_increasing_id, below the partition's number


def _built(df: DataFrame, col: str, order: str) -> tuple[DataFrame, int, int]:
    """A dictionary, with its number of labels and bytes."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    spark = df.sparkSession
    counted = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    keys = [F.col("n").desc(), F.col("value").asc()] if order == "frequencyDesc" else [F.col("value").asc()]
    number = F.monotonically_increasing_id()
    # Written, so that all readers below see the same ranges whatever becomes of an executor.
    path = scratch_path(spark, "dictionary")
    (counted.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .select("value", "n", F.shiftright(number, _PLACE_BITS).cast("int").alias("range"),
             number.bitwiseAND((1 << _PLACE_BITS) - 1).alias("place")).write.parquet(path))
    placed = spark.read.schema(f"value {df.schema[col].dataType.simpleString()}, n long, range int, place long").parquet(path)
    # A row for each range, of which there are as many as shuffle partitions.
    totals = {r["range"]: r for r in placed.groupBy("range").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.octet_length(F.col("value").cast("string")) + 16).alias("b")).collect()}
    offsets, labels = [], 0
    for at in range(max(totals, default=-1) + 1):
        offsets.append(labels)
        labels += totals[at]["c"] if at in totals else 0
    offset = F.element_at(F.lit(offsets or [0]).cast("array<bigint>"), F.col("range") + 1)
    return (placed.select("value", "n", (F.col("place") + offset).alias("code")), labels, sum(r["b"] for r in totals.values()))


def dictionary(df: DataFrame, col: str, order: str = "frequencyDesc") -> DataFrame:
    """(value, n, code) of each value of ``col`` that isn't NULL; codes are longs from 0 without gaps."""
    return _built(df, col, order)[0]


def _measured(codes: DataFrame) -> tuple[DataFrame, int, int]:
    size = codes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("value").cast("string")) + 16).alias("b")).first()
    return codes, size["n"], size["b"] or 0


def encode(df: DataFrame, cols: Sequence[str], order: str = "frequencyDesc", handle_invalid: str = "keep",
           dictionaries: dict[str, DataFrame] | None = None, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Add ``<col>_index`` (double) for each column, by its own dictionary or a given one.

    A value without a code, NULL included, gets the number of labels (``keep``), makes the
    query fail (``error``) or drops its row (``skip``).
    """
    if handle_invalid not in ("keep", "error", "skip"):
        raise ValueError("handle_invalid must be keep, error or skip")
    given = dictionaries or {}
    with ThreadPoolExecutor(max_workers=max(1, len(cols))) as pool:  # a dictionary for each column, side by side
        build = inheritable_thread_target(df.sparkSession)(
            lambda c: _measured(given[c]) if c in given else _built(df, c, order))
        built = list(pool.map(build, cols))
    out = df
    for c, (codes, labels, size) in zip(cols, built, strict=True):
        side = codes.select(F.col("value").alias("_value"), F.col("code").cast("double").alias("_code"))
        side = F.broadcast(side) if size <= max_broadcast else side
        out = out.join(side, out[c] == F.col("_value"), "inner" if handle_invalid == "skip" else "left")
        none = (F.lit(float(labels)) if handle_invalid == "keep"
                else F.raise_error(F.concat(F.lit(f"{c}: no code for "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))).cast("double"))
        code = F.col("_code") if handle_invalid == "skip" else F.coalesce("_code", none)
        out = out.withColumn(f"{c}_index", code).drop("_value", "_code")
    return out
