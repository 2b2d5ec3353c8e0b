"""Sampling, splitting and partition control (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as K
from ..operators import profile as P
from ..operators import sampling as SM
from ..session import scratch_path
from ..sources import files as IO
from ..sources.campaigns import campaigns
from .oracle import VALIDATED_CTE, hash_unit_sql, with_campaigns
from .q_clean import model_table
from .registry import register

S = "sampling"
SEED = 42
TRAIN = 0.8
SAMPLE_FRACTION = 0.5
FOLDS = 3


@register("hash_split", with_campaigns(
    f"SELECT id, CASE WHEN {hash_unit_sql('id', SEED)} < {SM.threshold(TRAIN)} THEN 'train' ELSE 'test' END AS split "
    "FROM campaigns"), S)
def hash_split(spark, sf):
    return SM.with_split(campaigns(spark, sf, ["id"]), "id", TRAIN, SEED)


@register("split_report", with_campaigns(f"""
SELECT n_train, n_test, n_total, ROUND(CAST(n_train AS DOUBLE) / CAST(n_total AS DOUBLE), 6) AS train_share,
       ABS(ROUND(CAST(n_train AS DOUBLE) / CAST(n_total AS DOUBLE), 6) - {TRAIN}) <= 0.05 AS share_ok
FROM (SELECT CAST(SUM(CASE WHEN {hash_unit_sql('id', SEED)} < {SM.threshold(TRAIN)} THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
             CAST(SUM(CASE WHEN {hash_unit_sql('id', SEED)} < {SM.threshold(TRAIN)} THEN 0 ELSE 1 END) AS BIGINT) AS n_test,
             COUNT(*) AS n_total FROM validated) t""", VALIDATED_CTE), S)
def split_report(spark, sf):
    return SM.split_report(K.validate(model_table(spark, sf)), "id", TRAIN, SEED)


@register("hash_sample", with_campaigns(
    f"SELECT id, goal FROM campaigns WHERE {hash_unit_sql('id', SEED, 'sample')} < {SM.threshold(SAMPLE_FRACTION)}"), S)
def hash_sample(spark, sf):
    return SM.hash_sample(campaigns(spark, sf, ["id", "goal"]), SAMPLE_FRACTION, "id", SEED)


@register("kfold", with_campaigns(
    f"SELECT id, CAST({hash_unit_sql('id', SEED, 'fold')} % {FOLDS} AS INTEGER) AS fold FROM campaigns"), S)
def kfold(spark, sf):
    return SM.kfold(campaigns(spark, sf, ["id"]), FOLDS, "id", SEED)


PARTITIONS = 8


@register("repartition_balance", with_campaigns(
    f"SELECT COUNT(*) AS n_rows, CAST({PARTITIONS} AS BIGINT) AS n_partitions, TRUE AS balanced FROM validated",
    VALIDATED_CTE), S)
def repartition_balance(spark, sf):
    """All rows are there, and partitions differ by one row per input partition at most."""
    df = K.validate(model_table(spark, sf))
    sizes = SM.partition_sizes(SM.repartition_balance(df, PARTITIONS))
    return sizes.agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_partitions"),
                     (F.max("n_rows") - F.min("n_rows") <= df.rdd.getNumPartitions()).alias("balanced"))


@register("cache_scope", with_campaigns(
    "SELECT state, COUNT(*) AS n, (SELECT COUNT(*) FROM validated) AS n_total FROM validated GROUP BY state",
    VALIDATED_CTE), S)
def cache_scope(spark, sf):
    """Two aggregates over one persisted table, in a result that outlives the cache."""
    with SM.cache_scope(K.validate(model_table(spark, sf))) as cached:
        total = cached.agg(F.count(F.lit(1)).alias("n_total"))  # one row
        out = P.class_distribution(cached).select("state", "n").join(F.broadcast(total))
        path = IO.write_parquet(out.select("state", "n", "n_total"), scratch_path(spark, "cache_scope"))
    return spark.read.parquet(path)


@register("lineage_checkpoint", with_campaigns(
    "SELECT id, goal, category, country, launched_at, deadline, staff_pick, state FROM validated", VALIDATED_CTE), S)
def lineage_checkpoint(spark, sf):
    return SM.lineage_checkpoint(K.validate(model_table(spark, sf)))
