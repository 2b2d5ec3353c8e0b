"""Sources and sinks (§2.1): round trips through CSV, Parquet and JSON."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean as K
from ..operators import enrich as E
from ..operators import profile as P
from ..session import scratch_path
from ..sources import files as IO
from ..sources.campaigns import campaigns, snapshot
from ..sources.schema import CAMPAIGN_SCHEMA, MODEL_COLUMNS, RAW_CSV_SCHEMA
from .oracle import FEATURES_CTE, VALIDATED_CTE, with_campaigns
from .q_clean import LOOKUP_SQL, feature_table
from .q_profile import MERGED_SQL, VF
from .registry import register

S = "io"
STORE_SCHEMA = T.StructType(CAMPAIGN_SCHEMA.fields + [T.StructField("region", T.StringType())])
PRUNED_COUNTRY = "NATION_1"
_stores: dict = {}
_lock = threading.Lock()

STORE_SQL = VALIDATED_CTE + ",\n" + LOOKUP_SQL + """,
store AS (SELECT v.*, l.region FROM validated v LEFT JOIN lookup l ON v.country = l.country)"""


def enriched_store_df(spark, sf):
    """Validated campaigns with their region: what ingestion persists."""
    return E.region_enrich(K.validate(campaigns(spark, sf)), E.region_lookup(spark, sf)) \
        .select(*[f.name for f in STORE_SCHEMA.fields])


def campaign_store(spark, sf) -> str:
    """Country-partitioned Parquet store, written once per application and sf."""
    key = (spark.sparkContext.applicationId, sf, snapshot(spark, sf))
    with _lock:
        if key not in _stores:
            _stores[key] = IO.write_partitioned(enriched_store_df(spark, sf), scratch_path(spark, "store"))
    return _stores[key]


@register("csv_scan", with_campaigns("SELECT * FROM campaigns"), S)
def csv_scan(spark, sf):
    path = IO.write_csv(campaigns(spark, sf), scratch_path(spark, "csv"))
    return IO.read_campaigns_csv(spark, path)


_RAW = {f.name: f.dataType for f in RAW_CSV_SCHEMA.fields}
_RAW_SQL = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
            T.BooleanType: "BOOLEAN"}


@register("raw_csv_scan", with_campaigns("SELECT " + ", ".join(
    n if n in CAMPAIGN_SCHEMA.names else f"CAST(NULL AS {_RAW_SQL[type(t)]}) AS {n}" for n, t in _RAW.items())
    + " FROM campaigns"), S)
def raw_csv_scan(spark, sf):
    """The 41-column export, written in another column order and read by its header."""
    df = campaigns(spark, sf)
    raw = df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in sorted(_RAW.items())])
    path = IO.write_csv(raw, scratch_path(spark, "raw_csv"))
    return IO.read_campaigns_csv(spark, path, schema=RAW_CSV_SCHEMA, required=MODEL_COLUMNS)


@register("parquet_partitioned_write", with_campaigns("SELECT * FROM store", STORE_SQL), S)
def parquet_partitioned_write(spark, sf):
    path = IO.write_partitioned(enriched_store_df(spark, sf), scratch_path(spark, "partitioned"))
    return IO.read_campaigns(spark, path, schema=STORE_SCHEMA)


@register("parquet_scan", with_campaigns(
    f"SELECT id, {', '.join(MODEL_COLUMNS)} FROM store", STORE_SQL), S)
def parquet_scan(spark, sf):
    return IO.read_campaigns(spark, campaign_store(spark, sf), ["id", *MODEL_COLUMNS], schema=STORE_SCHEMA)


@register("partition_pruned_count", with_campaigns(
    f"SELECT COUNT(*) AS n_rows FROM store WHERE country = '{PRUNED_COUNTRY}'", STORE_SQL), S)
def partition_pruned_count(spark, sf):
    df = IO.read_campaigns(spark, campaign_store(spark, sf), ["country"], schema=STORE_SCHEMA)
    return df.filter(F.col("country") == PRUNED_COUNTRY).agg(F.count(F.lit(1)).alias("n_rows"))


# A country's files follow its rows: at least one for each IO.ROWS_PER_FILE of them, and at most twice as many.
@register("partition_inventory", with_campaigns("""
SELECT country, COUNT(*) AS n_rows, TRUE AS files_follow_rows FROM store GROUP BY country""", STORE_SQL), S)
def partition_inventory(spark, sf):
    """Rows of each country, counted from the footers, and whether its files are as many as these rows ask for."""
    least = F.ceil(F.col("n_rows") / IO.ROWS_PER_FILE)
    return IO.partition_inventory(spark, campaign_store(spark, sf), schema=STORE_SCHEMA).select(
        "country", "n_rows", F.col("n_files").between(least, 2 * least).alias("files_follow_rows"))


@register("partition_files", None, S)
def partition_files(spark, sf):
    """The files and rows of each country, as the store has been laid out."""
    return IO.partition_inventory(spark, campaign_store(spark, sf), schema=STORE_SCHEMA)


@register("features_write", with_campaigns(
    "SELECT id, goal, category, country, launched_at, deadline, staff_pick, state, duration, "
    "ROUND(goal_log, 6) AS goal_log FROM features", VALIDATED_CTE + ",\n" + FEATURES_CTE), S)
def features_write(spark, sf):
    path = IO.write_parquet(feature_table(spark, sf), scratch_path(spark, "features"))
    back = spark.read.parquet(path)
    return back.withColumn("goal_log", F.round("goal_log", 6))


HIST_SCHEMA = T.StructType([T.StructField("bucket_idx", T.IntegerType()),
                            T.StructField("goal_count", T.LongType()),
                            T.StructField("goal_log_count", T.LongType())])


@register("histogram_csv_sink", with_campaigns("SELECT * FROM merged", VF + ",\n" + MERGED_SQL), S)
def histogram_csv_sink(spark, sf):
    # The merged histogram is bounded by the split count (62 rows): one file.
    merged = P.histogram_merge(feature_table(spark, sf)).coalesce(1).orderBy("bucket_idx")
    path = IO.write_csv(merged, scratch_path(spark, "histogram"))
    return IO.read_campaigns_csv(spark, path, schema=HIST_SCHEMA, multiline=False)
