"""Multi-line CSV files read in splits.

Whether a line of a file begins inside a quoted field depends on all lines before it, so Spark reads such a
file in one task. But only the number of quotes before it matters, odd or even (a doubled quote inside a
field counts twice and changes nothing), and that is a prefix sum:

1. Lines are read in splits, and for each split the parity of its quotes and its first and last line with an odd
   number of them are found: a row for each split.
2. Prefix sums of these rows give each split's state at its start. A split that begins inside a field has a head up
   to its first odd line; one that ends inside a field has a tail from its last odd line on. Tails, splits
   without any odd line and the head after them are one record.
3. All other lines begin and end outside of fields in their own split: each task puts its lines together as records.
   The few lines of heads and tails are brought together by the split where their record begins.
4. Records are parsed by ``from_csv``, with the parser and the options of the file reader.

The rows of step 1 are broadcast: one for each split of ``spark.sql.files.maxPartitionBytes``, a millionth of the input.
The text is scanned three times and only heads and tails are shuffled.

Quotes must be used as the dialect has it: only around a field, and doubled inside. A file that has single quote
characters in fields without quotes has to be read whole. Records end with a line feed, or with a carriage return and
a line feed if the file's first line does; line ends inside of fields are kept as they are.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOVED = "the splits of the files changed between two scans; set spark.sql.files.minPartitionNum"
_BOM = "\ufeff"


def fix_splits(spark: SparkSession) -> None:
    """Make splits depend on the files alone: while unset, Spark takes the number of cores that it has at the moment
    for ``spark.sql.files.minPartitionNum``, and this may change from scan to scan."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """value, file, start (of the split), line (ascending within a split), odd (an odd number of quotes)."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("line"), (quotes % 2 == 1).alias("odd"))


def splits(lines: DataFrame) -> DataFrame:
    """A row for each split: its lines (first to last), head and tail, the split in which its head's record begins,
    and whether its file has carriage returns."""
    odd_line = F.when(F.col("odd"), F.col("line"))
    rows = lines.groupBy("file", "start").agg(
        F.min("line").alias("first"), F.max("line").alias("last"), F.min(odd_line).alias("first_odd"), F.max(odd_line).alias("last_odd"),
        F.count_if("odd").alias("odds"), F.min_by(F.col("value").endswith("\r"), "line").alias("returns"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1
    ends_inside = inside != (F.col("odds") % 2 == 1)
    marked = (rows.withColumn("inside", inside)
              .withColumn("head_to", F.when(F.col("inside"), F.coalesce("first_odd", "last")))
              # A split that is inside of one field from end to end has no tail of its own.
              .withColumn("tail_from", F.when(ends_inside & F.col("last_odd").isNotNull(), F.col("last_odd"))))
    opened = F.last(F.when(F.col("tail_from").isNotNull(), F.col("start")), ignorenulls=True)
    return marked.select("file", "start", "first", "last", "head_to", "tail_from", opened.over(before).alias("opened"),
                         F.first("returns").over(Window.partitionBy("file").orderBy("start")).alias("returns"))


def _whole(names: Sequence[str] | None):
    """Lines to records; a task's lines begin and end outside of fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.RecordBatch | None = None
        for batch in batches:
            if left is not None and left.num_rows:
                batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            odd = batch.column("odd").to_numpy(zero_copy_only=False)
            closed = np.flatnonzero(np.cumsum(odd) % 2 == 0)
            ends = closed + 1
            done = int(ends[-1]) if len(ends) else 0
            left = batch.slice(done)
            if not done:
                continue
            starts = np.concatenate([[0], ends[:-1]])
            value = batch.column("value").slice(0, done)
            if len(ends) < done:
                value = pa.concat_arrays([value])  # offsets from 0 on
                value = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, done), pa.int32()), value), "\n")
            header = batch.column("header").to_numpy(zero_copy_only=False)[starts]
            returns, file = (batch.column(c).take(pa.array(starts)) for c in ("returns", "file"))
            for k in np.flatnonzero(header):
                own = next(csv.reader([value[int(k)].as_py().removeprefix(_BOM).removesuffix("\r")]), [])
                if names is not None and own != list(names):
                    raise ValueError(f"the header of a file differs: {own} instead of {list(names)}")
            kept = pa.array(~header)
            yield pa.RecordBatch.from_arrays([value.filter(kept), returns.filter(kept), file.filter(kept)],
                                             names=["record", "returns", "file"])

    return run


def records(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] | None = None, with_file: bool = False) -> DataFrame:
    """The text of each record, without the files' headers, which must be ``names`` if given; and its file, or NULL."""
    fix_splits(spark)
    lines = numbered_lines(spark, path)
    rows = splits(lines).withColumnsRenamed({"file": "_f", "start": "_s"})
    shown = (F.col("file") if with_file else F.lit(None).cast("string")).alias("file")
    placed = lines.join(F.broadcast(rows), (F.col("file") == F.col("_f")) & (F.col("start") == F.col("_s")), "left")
    same = F.coalesce(F.col("line").between(F.col("first"), F.col("last")), F.lit(False))
    placed = placed.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit(MOVED)).cast("boolean")))
    in_head, in_tail = F.coalesce(F.col("line") <= F.col("head_to"), F.lit(False)), F.coalesce(F.col("line") >= F.col("tail_from"), F.lit(False))
    header = (F.col("start") == 0) & (F.col("line") == F.col("first"))
    whole = (placed.filter(~in_head & ~in_tail).select("value", "odd", header.alias("header"), "returns", shown)
             .mapInArrow(_whole(names), "record string, returns boolean, file string"))
    # A record over several splits; a tail begins one of its own also where its split has a head.
    parts = (placed.filter(in_head | in_tail)
             .select("file", F.when(in_tail, F.col("start")).otherwise(F.col("opened")).alias("opened"), "start", "line", "value", "returns",
                     (in_tail & header).alias("header")))
    joined = parts.groupBy("file", "opened").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "line", "value"))), lambda x: x.value), "\n").alias("record"),
        F.first("returns").alias("returns"), F.bool_or("header").alias("header")).filter(~F.col("header"))
    both = whole.unionByName(joined.select("record", "returns", shown))
    ended = F.when(F.col("returns") & F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return both.select(ended.alias("record"), "file").filter("record <> ''")


def parsed(records_: DataFrame, schema: T.StructType, options: dict[str, str], file_col: str | None = None) -> DataFrame:
    """The columns of ``schema`` from the text of records, and their file as ``file_col`` if that is given."""
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    row: Column = F.from_csv("record", ddl, {**options, "header": "false", "multiLine": "true"})
    return records_.select(row.alias("_row"), "file").select("_row.*", *([F.col("file").alias(file_col)] if file_col else []))
