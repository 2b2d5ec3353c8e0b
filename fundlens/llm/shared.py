"""Helpers of several operators: written tables and bounded filters of ids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bits of an id filter. Its size is this at most, whatever the number of ids.
FILTER_BITS = 1 << 24


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder of spark.checkpoint.dir, gone with ``session.clear_scratch``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: Column, text: Column) -> Column:
    """The id as a string that is never null: a row without an id has its text's digest."""
    return F.coalesce(F.concat(F.lit("i"), id_col.cast("string")), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))


def key_id(key: Column, kind) -> Column:
    """The id of a ``row_key``; null for a row without one."""
    return F.when(key.startswith("i"), F.substr(key, F.lit(2)).cast(kind))


def id_filter(ids: DataFrame, bits: int = FILTER_BITS):
    """A function from an id column to a boolean column that holds for each id of
    the single-column ``ids``, and by chance for some others.

    It only spares rows a shuffle whose join then decides. The bits are
    gathered in blocks of 4 KB; there are bits / 32768 blocks at most.
    """
    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits))
    blocks = (ids.select(F.shiftright(place, 15).alias("b"), place.bitwiseAND(32767).alias("p"))
              .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    table = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for b, m in blocks:
        table[b * 4096:b * 4096 + len(m)] = np.frombuffer(m, dtype=np.uint8)
    held = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(places: pd.Series) -> pd.Series:
        p = places.to_numpy()
        return pd.Series((held.value[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool))

    return lambda column: test(F.pmod(F.xxhash64(column), F.lit(bits)))
