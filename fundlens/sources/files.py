"""CSV / Parquet / JSON sources and sinks for campaign tables.

Writes go under the shared ``spark.checkpoint.dir`` (see ``session.scratch_path``)
or a caller-given path, never a machine-local temp folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import csv_split
from .schema import CAMPAIGN_SCHEMA

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"
#: Rows of a partitioned file, unless the caller says otherwise.
ROWS_PER_FILE = 1_000_000


def header_schema(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (),
                  multiline: bool = True) -> T.StructType:
    """``schema`` in the order of the files' header: only the header is read.

    Columns that ``schema`` does not have are strings. A required column that the
    header lacks is an error.
    """
    names = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower()).csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    known = {f.name: f.dataType for f in schema.fields}
    return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])


def read_campaigns_csv(spark: SparkSession, path: str, schema: T.StructType | None = CAMPAIGN_SCHEMA,
                       infer: bool = False, multiline: bool = True, required: Sequence[str] = (),
                       keep_corrupt: bool = False, split: bool = True) -> DataFrame:
    """Read campaign CSV: header, quoted multi-line text, doubled quotes.

    Columns are found by their names in the header, in whatever order a file
    has them; all files must have the same header (Spark checks each). The
    result has the columns of ``schema``, NULL where the files lack one;
    ``required`` ones must be there, or the read fails before any row.
    ``infer=True`` asks Spark to infer types instead. With ``keep_corrupt``,
    the text of rows that don't fit the schema is kept in ``_corrupt_record``
    (their other columns are as far as they could be read).

    Files with embedded newlines are read in splits (see ``csv_split``). ``split=False`` reads each in
    one task, as files with quote characters inside of unquoted fields need it, and so does ``infer``;
    ``multiline=False`` is the quickest for exports without embedded newlines.
    """
    r = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
    if infer or schema is None:
        df = r.option("inferSchema", "true").csv(path)
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"missing required columns: {missing}")
        return df
    own = header_schema(spark, path, schema, required, multiline)
    if keep_corrupt:
        own = own.add(CORRUPT, T.StringType())
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if not own.fields:  # no file, or an empty one
        return spark.createDataFrame([], schema)
    if multiline and split:
        names = [n for n in own.names if n != CORRUPT or not keep_corrupt]
        more = {"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {}
        df = csv_split.parsed(csv_split.records(spark, path, names), own, CSV_OPTIONS | more)
    else:
        df = r.option("enforceSchema", "false").schema(own).csv(path)
    there = set(own.names)
    return df.select(*[F.col(f"`{f.name}`") if f.name in there else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields], *([CORRUPT] if keep_corrupt else []))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}).csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("country",),
                      mode: str = "overwrite", max_records_per_file: int = ROWS_PER_FILE, dynamic: bool = False) -> str:
    """Snappy Parquet partitioned by ``partition_by``; ``dynamic`` replaces only partitions that have rows.

    The rows of each key are counted, and dealt to as many tasks as the
    key fills files: files per key follow its rows, not the number of tasks
    that hold some, and a key with a third of all rows is still written in parallel.
    """
    from ..operators.enrich import sized_broadcast

    keys = list(partition_by)
    # A row for each partition folder.
    salts = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / max_records_per_file).cast("int").alias("_salts"))
    salts = sized_broadcast(written(salts, "salts"))  # counted once; not broadcast, all rows would be shuffled for the join, too
    same = [F.col(f"_d.{k}").eqNullSafe(F.col(f"_s.{k}")) for k in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    dealt = (df.alias("_d").join(salts.alias("_s"), on, "left")
             .select("_d.*", F.pmod(F.xxhash64(*[F.col(f"_d.`{c}`") for c in df.columns]),
                                    F.coalesce("_s._salts", F.lit(1))).alias("_salt")))
    (dealt.repartition(*keys, "_salt").sortWithinPartitions(*keys).drop("_salt")
     .write.mode(mode).partitionBy(*keys).option("maxRecordsPerFile", max_records_per_file)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: what is costly to derive is derived once, however often it is read."""
    return df.sparkSession.read.schema(df.schema).parquet(write_parquet(df, scratch_path(df.sparkSession, name)))


def read_campaigns(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   schema: T.StructType | None = CAMPAIGN_SCHEMA) -> DataFrame:
    """Read campaign Parquet; partition columns take their type from ``schema``
    (no partition-value inference), and only ``columns`` are read."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.parquet(path)
    return df.select(*columns) if columns else df


def partition_inventory(spark: SparkSession, path: str, partition_col: str = "country",
                        schema: T.StructType | None = CAMPAIGN_SCHEMA) -> DataFrame:
    """(partition value, files, rows) from the ``_metadata`` file path column."""
    df = read_campaigns(spark, path, schema=schema)
    return df.select(partition_col, F.col("_metadata.file_path").alias("_file")).groupBy(partition_col).agg(
        F.count_distinct("_file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
