"""Lookup enrichment: region join, member exclusion, unmapped keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.campaigns import load_table

# A lookup is broadcast only when its rows and its bytes prove it small; above
# either the join falls back to a shuffle (sort-merge) join.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 << 20


def sized_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a check of rows and of their text size (one small job on the lookup)."""
    size = F.octet_length(F.to_json(F.struct("*")))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return F.broadcast(df) if n <= max_rows and (total or 0) <= max_bytes else df


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, region) of every nation whose region is known."""
    nation = load_table(spark, sf_dir, "nation", ["n_name", "n_regionkey"])
    region = load_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner") \
        .select(F.col("n_name").alias("country"), F.col("r_name").alias("region"))


# The ISO-country -> region mapping used for real campaign
# exports (25 codes, four regions).
ISO_REGION_ROWS = [
    ("US", "North America"), ("CA", "North America"), ("MX", "North America"),
    ("GB", "Europe"), ("DE", "Europe"), ("FR", "Europe"), ("IT", "Europe"),
    ("ES", "Europe"), ("NL", "Europe"), ("SE", "Europe"), ("NO", "Europe"),
    ("DK", "Europe"), ("CH", "Europe"), ("BE", "Europe"), ("AT", "Europe"),
    ("IE", "Europe"), ("PL", "Europe"), ("LU", "Europe"), ("SI", "Europe"), ("GR", "Europe"),
    ("AU", "Oceania"), ("NZ", "Oceania"),
    ("JP", "Asia"), ("HK", "Asia"), ("SG", "Asia"),
]


def iso_region_lookup(spark: SparkSession) -> DataFrame:
    """The ISO lookup as an inline VALUES relation (planned in the JVM)."""
    values = ", ".join(f"('{c}', '{r}')" for c, r in ISO_REGION_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(country, region)")


def region_enrich(df: DataFrame, lookup: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join on country; unmatched countries get a NULL region."""
    return df.join(sized_broadcast(lookup, max_broadcast_rows), "country", "left")


def unmapped_countries(df: DataFrame, lookup: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Countries of ``df`` the lookup misses, with their campaign counts."""
    miss = df.select("country").join(sized_broadcast(lookup.select("country"), max_broadcast_rows),
                                     "country", "left_anti")
    return miss.groupBy("country").agg(F.count(F.lit(1)).alias("n_campaigns"))
