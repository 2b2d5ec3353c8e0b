"""Incremental refresh of a partitioned store from the CSV files that it was made of.

Each row of the store carries the identity of its file (path, bytes and time of change). A refresh compares the files
there now with those in the store: rows of new files are read and validated, rows of files that are gone or
changed are left out, and only partitions that either touches are written again (dynamic partition overwrite).
All other partitions keep their files. The list of files that are wholly in the store is written last, beside it
(``_files``, which readers of the store pass over). A refresh that was broken off can simply be run again: rows of a file
that isn't listed count as stale, wherever they got to, and the file as new. Without a list everything is read anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import csv_split
from .files import CSV_OPTIONS, ROWS_PER_FILE, header_schema, write_partitioned

SOURCE = "source_file"


def _identity(path: Column, size: Column, modified: Column) -> Column:
    return F.concat_ws("|", path, size.cast("string"), F.unix_millis(modified).cast("string"))


def source_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Identity to path of each CSV file there: a row for each file, none of their content."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select(
        "path", _identity(F.col("path"), F.col("length"), F.col("modificationTime")).alias("i")).collect()
    return {r["i"]: r["path"] for r in rows}


def _read(spark: SparkSession, files: dict[str, str], schema: T.StructType, required: Sequence[str]) -> DataFrame:
    """The rows of some files with the identity of theirs."""
    paths = sorted(files.values())
    own = header_schema(spark, paths[0], schema, required)
    rows = csv_split.parsed(csv_split.records(spark, paths, own.names, with_file=True), own, CSV_OPTIONS, "_file")
    # Spark writes a file's path in several ways (one slash or three after the scheme).
    plain = F.regexp_replace("_file", "^file:/+", "file:/")
    known = spark.createDataFrame([(p, i) for i, p in files.items()], "_path string, _id string").withColumn(
        "_path", F.regexp_replace("_path", "^file:/+", "file:/"))
    there = set(own.names)
    return rows.join(F.broadcast(known), plain == F.col("_path"), "left").select(
        *[F.col(f"`{f.name}`") if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
        F.coalesce("_id", F.raise_error(F.lit("a file was replaced while it was read")).cast("string")).alias(SOURCE))


def refresh(spark: SparkSession, csv_path: str, store: str, schema: T.StructType, clean: Callable[[DataFrame], DataFrame],
            partition_col: str = "country", required: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> dict[str, int]:
    """Bring the store up to the files of a folder; returns the numbers of files added and removed and of partitions written.

    ``clean`` turns read rows (with the column ``source_file``, which it keeps) into the store's rows. It must
    treat each row by itself.
    """
    files = source_files(spark, csv_path)
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = jvm.Path(store)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    empty = clean(spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(SOURCE, T.StringType())])))
    old = spark.read.schema(empty.schema).parquet(store) if system.exists(folder) else empty
    held = {r[SOURCE] for r in old.select(SOURCE).distinct().collect()}  # a row for each file
    listed = jvm.Path(store, "_files")
    whole = ({r[SOURCE] for r in spark.read.schema(f"{SOURCE} string").parquet(listed.toString()).collect()}
             if system.exists(jvm.Path(listed, "_SUCCESS")) else set())
    added = {i: p for i, p in files.items() if i not in whole}
    removed, gone = whole - set(files), held - (whole & set(files))
    new = clean(_read(spark, added, schema, required)) if added else empty
    lost = old.filter(F.col(SOURCE).isin(sorted(gone)))
    # A row for each touched partition.
    touched = [r[0] for r in new.select(partition_col).union(lost.select(partition_col)).distinct().collect()]
    counts = {"added": len(added), "removed": len(removed), "partitions": len(touched)}
    if touched:
        part = F.col(partition_col)
        within = part.isin([t for t in touched if t is not None]) | (part.isNull() if None in touched else F.lit(False))
        rows = old.filter(within & ~F.col(SOURCE).isin(sorted(gone))).unionByName(new)
        left = {r[0] for r in rows.select(partition_col).distinct().collect()}
        write_partitioned(rows, store, (partition_col,), "overwrite", rows_per_file, dynamic=True)
        for value in set(touched) - left:  # partitions without rows any more
            name = value if value is not None else "__HIVE_DEFAULT_PARTITION__"
            system.delete(jvm.Path(store, f"{partition_col}={name}"), True)
    if added or removed:
        spark.createDataFrame([(i,) for i in files], f"{SOURCE} string").coalesce(1).write.mode("overwrite").parquet(listed.toString())
    return counts
