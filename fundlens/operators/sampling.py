"""Repeatable splits, samples and folds; partition and cache control.

``randomSplit``/``sample`` membership depends on how rows are partitioned,
so the same seed selects different rows on a different cluster layout. The
hash rules here depend only on (seed, key): ``md5('<seed>:<key>')``'s first
32 bits as a fraction of 2**32. They are per-row expressions, need no
shuffle and give the same rows in DuckDB (see the oracle SQL).
"""

from __future__ import annotations

import contextlib

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO32 = 1 << 32


def hash_unit(key="id", seed: int = 42, salt: str = "") -> Column:
    """Deterministic uniform value in [0, 2**32) from (seed, salt, key)."""
    k = F.col(key) if isinstance(key, str) else key
    prefix = f"{seed}:{salt + ':' if salt else ''}"
    h = F.substring(F.md5(F.concat(F.lit(prefix), k.cast("string"))), 1, 8)
    return F.conv(h, 16, 10).cast("long")


def threshold(fraction: float) -> int:
    return int(fraction * TWO32)


def in_fraction(fraction: float, key="id", seed: int = 42, salt: str = "") -> Column:
    return hash_unit(key, seed, salt) < F.lit(threshold(fraction))


def with_split(df: DataFrame, key: str = "id", train_fraction: float = 0.8, seed: int = 42,
               col: str = "split") -> DataFrame:
    return df.withColumn(col, F.when(in_fraction(train_fraction, key, seed), F.lit("train")).otherwise(F.lit("test")))


def hash_split(df: DataFrame, key: str = "id", train_fraction: float = 0.8, seed: int = 42):
    """(train, test) by the hash rule."""
    cond = in_fraction(train_fraction, key, seed)
    return df.filter(cond), df.filter(~cond)


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42):
    """Spark's randomSplit, for parity with layouts that accept its variability."""
    return tuple(df.randomSplit([train_fraction, 1 - train_fraction], seed))


def split_report(df: DataFrame, key: str = "id", train_fraction: float = 0.8, seed: int = 42,
                 tolerance: float = 0.05) -> DataFrame:
    """train + test = total; train share within ``tolerance`` of the target, one pass."""
    cond = in_fraction(train_fraction, key, seed)
    return (df.agg(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias("n_train"),
                   F.sum(F.when(cond, 0).otherwise(1)).cast("long").alias("n_test"),
                   F.count(F.lit(1)).alias("n_total"))
              .withColumn("train_share", F.round(F.try_divide(F.col("n_train").cast("double"),
                                                              F.col("n_total").cast("double")), 6))
              .withColumn("share_ok", F.abs(F.col("train_share") - F.lit(train_fraction)) <= F.lit(tolerance)))


def hash_sample(df: DataFrame, fraction: float, key: str = "id", seed: int = 42) -> DataFrame:
    """Fraction of rows without replacement, fixed by (seed, key)."""
    return df.filter(in_fraction(fraction, key, seed, salt="sample"))


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's Bernoulli ``sample`` (membership depends on partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def kfold(df: DataFrame, k: int = 3, key: str = "id", seed: int = 42, col: str = "fold") -> DataFrame:
    """Fold number 0..k-1 per row (usable as CrossValidator ``foldCol``)."""
    return df.withColumn(col, F.pmod(hash_unit(key, seed, salt="fold"), F.lit(k)).cast("int"))


def repartition_balance(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Repartition to ``n`` (round-robin, or hash on ``cols``)."""
    return df.repartition(n, *cols) if cols else df.repartition(n)


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))


@contextlib.contextmanager
def cache_scope(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """persist -> use -> unpersist, even when the body raises."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def lineage_checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``.

    Survives executor loss (files, not executor memory); never a local
    checkpoint.
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
