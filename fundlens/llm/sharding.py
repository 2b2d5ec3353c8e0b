"""Contiguous shards of near equal bytes from global prefix sums.

The documents are put in one global order in which equal texts stand
together (digest of the text, then id) by a range partitioning, whose rows are
narrow: no text is shuffled. Each partition's bytes and rows are totalled, the
totals of the partitions before it are added to the sums within it, and the
global prefix sum is cut at equal targets. A document belongs to the shard in
which the middle of its bytes falls, so sizes differ from the target by less than one
document at either end. A group of equal texts into which a cut falls goes as a whole to the shard in which its own
middle falls, as long as it has ``WHOLE_SHARE`` of the target at most (sizes then differ by half of that more at
either end); a larger one is cut. There is one such group for each cut at most. Ranges split groups over partitions, as the
id is part of the key.

Law: bytes. Slots count a shard's rows from 0 in the global order.

Cases: a null text has no bytes and the digest of an empty one; long texts
only have their length and digest taken; equal texts are ordered by id, equal
rows share a key and still get slots of their own; an empty table gives an
empty result; other columns are passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Share of a shard's target up to which a group of equal texts is kept whole.
WHOLE_SHARE = 0.1


def shard_by_bytes(df: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   row_bytes: int = ROW_BYTES, whole_share: float = WHOLE_SHARE) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = df.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("_size"),
        F.crc32(text).alias("_crc"),
        F.xxhash64(text).alias("_key"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["_key", "_crc", "_id"]
    # Range bounds come from a sample; the checkpoint fixes them for both uses below.
    placed = (keyed.repartitionByRange(parts, *order)
              .withColumn("_part", F.spark_partition_id())
              .transform(checkpointed))
    # A row for each partition, of which there are as many as shuffle partitions.
    totals = placed.groupBy("_part").agg(F.sum("_size").alias("_b"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_b").over(every).alias("_all"),
    )
    within = Window.partitionBy("_part").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (placed
                .withColumn("_end", F.sum("_size").over(running))
                .withColumn("_row", F.row_number().over(within) - 1)
                .join(F.broadcast(offsets), "_part"))
    start = F.col("_bytes_before") + F.col("_end") - F.col("_size")

    def shard_of(first_byte, n_bytes):
        # Twice the middle, so that it stays whole. Decimals: all bytes times shards may pass 2^63.
        twice = (first_byte * 2 + n_bytes).cast("decimal(20,0)") * F.lit(int(n_shards)).cast("decimal(10,0)")
        return F.call_function("div", twice, (F.col("_all") * 2).cast("decimal(20,0)")).cast("int")

    single = numbered.select("_key", "_crc", "_id", "_size", "_all", start.alias("_start"), (F.col("_rows_before") + F.col("_row")).alias("_at"),
                             shard_of(start, F.col("_size")).alias("_own"))
    # Groups that a cut falls into: fewer than shards.
    parted = (single.groupBy("_key", "_crc").agg(F.min("_own").alias("_a"), F.max("_own").alias("_b"), F.min("_start").alias("_start"),
                                                 F.sum("_size").alias("_bytes"), F.first("_all").alias("_all"))
              .filter("_a <> _b").filter(F.col("_bytes") * int(n_shards) <= whole_share * F.col("_all"))
              .select("_key", "_crc", shard_of(F.col("_start"), F.col("_bytes")).alias("_whole")))
    cut = single.join(F.broadcast(parted), ["_key", "_crc"], "left").withColumn("shard", F.coalesce("_whole", "_own"))
    firsts = cut.groupBy("shard").agg(F.min("_at").alias("_first"))  # a row for each shard
    return cut.join(F.broadcast(firsts), "shard").select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard"), (F.col("_at") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder, so that lost executors change nothing."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
