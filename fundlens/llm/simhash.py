"""Near-duplicate documents by SimHash, with candidates pruned by pigeonring chains.

A document's fingerprint has 64 bits: a bit is one if over half of the hashes (XXH64, seed 42) of its
three words in a row have it. Two fingerprints link if they differ in at most ``MAX_BITS`` = 3 bits.

The 64 bits are a ring of ``SEGMENTS`` = 4 segments. If two fingerprints differ in d <= 3 bits, some
segment starts a chain in which each l consecutive segments differ in at most 3 l / 4 bits: the first
in none, the first two in one at most, the first three in two.

1. Documents are reduced to their distinct fingerprints; copies are one row from here on.
2. Each fingerprint goes into eight buckets: for every segment as the chain's first, the segment itself with
   either half of the next one (as that has one bit too many at most, one half is equal).
3. Inside a bucket the chain's budgets are checked one after the other, then the full distance.
   The bucket is walked from fingerprint to linked fingerprint, each
   compared with those that nothing has reached yet. So a bucket of c members gives c - 1 links at most,
   and these hold together just what all its links would.
4. Components of the links; each has the least document id of its fingerprints.

A bucket above ``MAX_BUCKET`` fingerprints is dealt as pairs of blocks to several tasks.

Cases: a null or empty text, or one without words, has the fingerprint zero, linked like any other; with one or
two words the whole sequence is the one shingle; texts are read whole, long ones in
parts; repeated rows and equal texts share a fingerprint; a null id takes its fingerprint's component, which is the least
id that isn't null (null if there is none); an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .shared import written

SHINGLE, SEED = 3, 42
MAX_BITS = 3
#: Segments of the ring, and the bits of each.
SEGMENTS, WIDTH = 4, 16
#: Fingerprints of a bucket that are compared in one task.
MAX_BUCKET = 4096
#: Bytes of a text that are split into words at a time.
PART = 1 << 20


def _parts(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; each list but the first begins with the last two words before it."""
    if len(data) <= PART:
        yield data.split()
        return
    kept, left = [], b""
    for at in range(0, len(data), PART):
        piece = left + data[at:at + PART]
        words = piece.split()
        if at + PART < len(data) and words and not piece[-1:].isspace():
            left = words.pop()  # it may go on
        else:
            left = b""
        words = kept + words
        yield words
        kept = words[-(SHINGLE - 1):]


def fingerprint(text: str | None) -> int:
    """The 64 bits of a text."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    ones, total, first = np.zeros(64, dtype=np.int64), 0, []
    hashed = xxhash.xxh64_intdigest
    for words in _parts(data):
        first = first if total else words
        hashes = [hashed(b" ".join(g), SEED) for g in zip(*(words[n:] for n in range(SHINGLE)), strict=False)]
        if hashes:
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
            total += len(hashes)
    if not total:
        return hashed(b" ".join(first), SEED) if first else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    seen: dict[str | None, int] = {}
    out = np.empty(len(texts), dtype=np.uint64)
    for n, t in enumerate(texts):
        if t not in seen:
            seen[t] = fingerprint(t)
        out[n] = seen[t]
    return pd.Series(out.view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint of a text column, as a long."""
    return F.pandas_udf(_fingerprints, "long")(text)


def bucket_keys(fp: Column) -> Column:
    """The eight buckets of a fingerprint: chain start, its segment, and a half of the next segment."""
    keys = []
    for start in range(SEGMENTS):
        own = F.shiftrightunsigned(fp, WIDTH * start).bitwiseAND(0xFFFF)
        after = F.shiftrightunsigned(fp, WIDTH * ((start + 1) % SEGMENTS)).bitwiseAND(0xFFFF)
        for half in range(2):
            part = F.shiftright(after, 8 * half).bitwiseAND(0xFF)
            keys.append((F.lit(2 * start + half) * (1 << 24) + own * 256 + part).cast("long"))
    return F.array(*keys)


def _chains(start: int) -> list[tuple[np.uint64, int]]:
    """Masks of the first two, three and four segments from ``start`` on, with the bits in which they may differ."""
    mask, out = 0, []
    for n in range(1, SEGMENTS + 1):
        mask |= 0xFFFF << WIDTH * ((start + n - 1) % SEGMENTS)
        out.append((np.uint64(mask), n * MAX_BITS // SEGMENTS))
    return out[1:]


def bucket_links(members: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray]]:
    """A fingerprint and those that were first reached from it, for all linked members of a bucket."""
    chains = _chains(start)
    rest = np.unique(members)
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            differ = rest ^ one
            near = np.arange(len(rest))
            for mask, most in chains:  # the last one is the full distance
                near = near[np.bitwise_count(differ[near] & mask) <= most]
            if len(near):
                found = rest[near]
                yield one, found
                reached.extend(found)
                rest = np.delete(rest, near)


def _bucket_sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket and block."""

    def of(keys: np.ndarray, fps: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
        a, b = [], []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            for one, found in bucket_links(fps[s:e].view(np.uint64), int(keys[s]) >> 25):
                a.append(np.full(len(found), one))
                b.append(found)
        a, b = (np.concatenate(x).view(np.int64) if x else np.empty(0, dtype=np.int64) for x in (a, b))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    key, block, fp = (np.empty(0, dtype=np.int64) for _ in range(3))
    for batch in batches:
        key = np.concatenate([key, batch["key"].to_numpy()])
        block = np.concatenate([block, batch["block"].to_numpy()])
        fp = np.concatenate([fp, batch["fp"].to_numpy()])
        starts = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        if len(starts):
            cuts = np.concatenate([[0], starts])
            yield of(key, fp, cuts)
            key, block, fp = (x[starts[-1]:] for x in (key, block, fp))
    if len(key):
        yield of(key, fp, np.array([0, len(key)]))


def links(distinct: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b): links between fingerprints of the column ``fp`` that hold all their components together."""
    keyed = distinct.select("fp", F.explode(bucket_keys(F.col("fp"))).alias("key"))
    sizes = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
             .select("key", F.ceil(F.col("c") / max_bucket).alias("blocks")))
    rows = (keyed.join(sizes, "key")
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
            # The pairs of blocks that this one is part of.
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("key", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"), "fp"))
    return (rows.repartition("key", "block").sortWithinPartitions("key", "block")
            .mapInPandas(_bucket_sweep, "a long, b long").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id."""
    id_type = df.schema[id_col].dataType
    docs = written(df.select(F.col(id_col).cast(id_type).alias("id"), fingerprints(F.col(text_col)).alias("fp")), "fingerprints")
    distinct = written(docs.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    groups = connected(links(distinct, max_bucket)).withColumnRenamed("id", "fp")
    named = distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "component").select("fp", "component_id")
    return (docs.join(classes, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
