"""Incremental ingestion of campaign CSV drops into the partitioned store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import validate
from ..operators.enrich import region_enrich
from ..sources.files import CSV_OPTIONS, header_schema
from ..sources.schema import CAMPAIGN_SCHEMA, DEFAULT_NOT_NULL


def campaign_stream(spark: SparkSession, source_dir: str, schema=CAMPAIGN_SCHEMA,
                    max_files_per_trigger: int | None = None, required=DEFAULT_NOT_NULL) -> DataFrame:
    """CSV drops as a stream, columns by the header of the files that are there at the
    start (as in the batch reader); a later file with another header fails its batch."""
    own = header_schema(spark, source_dir, schema, required)
    r = spark.readStream.schema(own).options(**CSV_OPTIONS).option("enforceSchema", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(source_dir)
    return df.select(*[F.col(f"`{f.name}`") if f.name in own.names else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def ingest_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  lookup: DataFrame | None = None, required=DEFAULT_NOT_NULL,
                  available_now: bool = True, schema=CAMPAIGN_SCHEMA) -> StreamingQuery:
    """Validate each micro-batch, enrich it with the (static, size-checked)
    lookup and append it to the country-partitioned Parquet store.

    The file sink plus ``checkpoint_dir`` (keep it on shared storage) give
    exactly-once output across driver restarts and executor loss.
    """
    df = validate(campaign_stream(spark, source_dir, schema, required=required), required)
    if lookup is not None:
        df = region_enrich(df, lookup)
    w = (df.writeStream.format("parquet").option("path", sink_dir)
           .option("checkpointLocation", checkpoint_dir).partitionBy("country").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
