"""The trie of conversations by their turns, built in sorted shards around a skeleton of splitters.

A turn is a piece of 20 bytes: the MD5 of role and text and the text's code points. A conversation is the
string of its pieces, its path. Texts stay where they are read; paths alone are shuffled.

1. Paths: turns are brought together by conversation, and a path is rebuilt from the first turns of another one
   where the caller names it (see ``rebuilt``). Equal paths are grouped in blocks of ids, so that copies of one
   conversation are a row for each ``BLOCK`` ids.
2. Splitters: evenly spaced paths of a sample of bounded size cut all paths into ranges. They
   decide how even the shards are, and nothing else.
3. Skeleton: the trie of the splitter paths (their first ``SPLIT_DEPTH`` turns), broadcast: ``MAX_SHARDS`` *
   ``SPLIT_DEPTH`` nodes at most. Paths that lie on both sides of a splitter and share a node share it with the
   splitter too, so any node outside the skeleton has all its members in one shard.
4. Each shard is sorted by path and swept once with the open path on a stack. Nodes outside the skeleton are finished there.
   For nodes of the skeleton the shard gives partial aggregates, and
   these are combined by a reduction; last, sums over subtrees go up the skeleton, and its nodes' ids
   down to the children that shards have finished.

A child waits for its parent's least member on the stack, within one shard's share of different paths. A list of ids that
end at a node is hashed as its blocks pass. What is held whole is one conversation's path, 20 bytes a turn.

Cases: a null role or text is empty; turns are ordered with a null turn first, equal turns by their pieces (MD5 of
role and text); a repeated row is one more turn; rows without a conversation id belong to none and are left out; a
conversation without turns ends at the root; texts of any length are read whole; an empty table has no node, not
even a root; other columns are passed over.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Bytes of a turn in a path: MD5, and the code points of its text.
PIECE = 20
#: Conversation ids of a block are equal above so many low bits.
BLOCK_BITS = 12
#: Ranges of paths, and turns of a splitter at most.
MAX_SHARDS, SPLIT_DEPTH = 1024, 32
#: Paths of the sample for each splitter.
SAMPLED = 16

NODE = ("skeleton long, conv_id long, depth long, parent_conv_id long, parent_skeleton long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NOTHING = hashlib.sha256(b"").hexdigest()


def piece(role: Column, text: Column) -> Column:
    """The 20 bytes of a turn."""
    chars = F.char_length(text)
    return F.unhex(F.concat(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)),
                            F.lpad(F.hex(chars.cast("long")), 8, "0")))


def paths(df: DataFrame, base: Column) -> DataFrame:
    """(base, id, path) of each conversation of (id, turn, role, text); rows of a base are together."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = df.filter("id IS NOT NULL").select(
        base.alias("base"), "id", F.struct(F.col("turn").isNotNull().alias("x"),
                                           F.coalesce("turn", F.lit(0)).alias("y"), piece(role, text).alias("z")).alias("t"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.hex(t.z)), "")
    return turns.repartition("base").groupBy("base", "id").agg(F.unhex(whole).alias("path"))


def rebuilt(df: DataFrame) -> DataFrame:
    """(id, path): the first h turns of conversation id - id % 100, then the own turns after the first h,
    with h = crc32(id) % 6."""
    own = paths(df, F.col("id") - F.col("id") % 100)
    h = (F.crc32(F.col("id").cast("string")) % 6).cast("int")
    # No more than five turns of the base are ever used.
    head = F.max(F.when(F.col("id") == F.col("base"), F.expr(f"substring(path, 1, {5 * PIECE})"))).over(Window.partitionBy("base"))
    return (own.withColumn("head", F.coalesce(head, F.lit(b""))).withColumn("h", h)
            .select("id", F.expr(f"concat(substring(head, 1, {PIECE} * h), substring(path, {PIECE} * h + 1))").alias("path")))


def skeleton(splitters: list[bytes]) -> tuple[dict[tuple[int, bytes], int], list[tuple[int, int, int]]]:
    """(node, piece) to child, and (parent, depth, code points) of each node; node 0 is the root."""
    child: dict[tuple[int, bytes], int] = {}
    nodes = [(-1, 0, 0)]
    for path in splitters:
        at = 0
        for d in range(0, len(path), PIECE):
            key = (at, path[d:d + PIECE])
            if key not in child:
                child[key] = len(nodes)
                nodes.append((at, d // PIECE + 1, int.from_bytes(key[1][16:], "big")))
            at = child[key]
    return child, nodes


class _Node:
    __slots__ = ("skeleton", "chars", "least", "n", "children", "leaves", "saved", "ends", "finished")

    def __init__(self, skeleton: int, chars: int) -> None:
        self.skeleton, self.chars = skeleton, chars
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.finished = None, []


class _Sweep:
    """Rows of a sorted shard, in; finished nodes and partial aggregates of the skeleton, out."""

    def __init__(self, child: dict[tuple[int, bytes], int]) -> None:
        self.child, self.stack, self.last, self.out = child, [_Node(0, 0)], b"", []

    def close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        ends = node.ends.hexdigest() if node.ends else None
        up = self.stack[-1] if self.stack else None
        if node.skeleton >= 0:
            if node.n:
                self.out.append((node.skeleton, node.least, depth, None, None, node.n, node.children, node.leaves, node.saved, ends))
        else:
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.chars
            for c in node.finished:
                self.out.append((None, c[0], depth + 1, node.least, None, *c[1:]))
            row = (node.least, node.n, node.children, node.leaves, node.saved, ends or NOTHING)
            if up.skeleton >= 0:  # its least member is known after the reduction
                self.out.append((None, row[0], depth, None, up.skeleton, *row[1:]))
            else:
                up.finished.append(row)
            up.children += 1
            up.leaves += node.leaves
            up.saved += node.saved
        if up is not None and node.n:
            up.n += node.n
            up.least = node.least if up.least is None else min(up.least, node.least)

    def add(self, path: bytes, n: int, least: int, ids: str) -> None:
        if path != self.last:
            same, most = 0, min(len(path), len(self.last))
            while same < most and path[same:same + PIECE] == self.last[same:same + PIECE]:
                same += PIECE
            while len(self.stack) > same // PIECE + 1:
                self.close()
            for d in range(same, len(path), PIECE):
                own, up = path[d:d + PIECE], self.stack[-1].skeleton
                self.stack.append(_Node(self.child.get((up, own), -1) if up >= 0 else -1, int.from_bytes(own[16:], "big")))
            self.last = path
        top = self.stack[-1]
        top.n += n
        top.least = least if top.least is None else min(top.least, least)
        if top.ends is None:
            top.ends = hashlib.sha256(ids.encode())
        else:
            top.ends.update(b"," + ids.encode())

    def taken(self) -> pd.DataFrame:
        out, self.out = self.out, []
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in NODE.split(", ")], dtype=object)
        return frame.astype({c: "Int64" for c in frame.columns[:-1]})


def _sweep(child):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sweep = _Sweep(child.value)
        for b in batches:
            for row in zip(b["path"], b["n"].tolist(), b["least"].tolist(), b["ids"], strict=True):
                sweep.add(*row)
            yield sweep.taken()
        while sweep.stack:
            sweep.close()
        yield sweep.taken()

    return run


def _combined(nodes: list[tuple[int, int, int]], partial: dict) -> list[tuple]:
    """The skeleton's finished nodes: their reduced aggregates, with sums of subtrees added from the deepest up."""
    children, leaves = ([partial[i][c] for i in range(len(nodes))] for c in ("n_children", "n_leaves"))
    saved = [partial[i]["saved_tokens"] + (partial[i]["n_convs"] - 1) * nodes[i][2] for i in range(len(nodes))]
    for i in range(len(nodes) - 1, 0, -1):  # a parent comes before its children
        up = nodes[i][0]
        leaves[i] = leaves[i] or 1
        children[up] += 1
        leaves[up] += leaves[i]
        saved[up] += saved[i]
    leaves[0] = leaves[0] or 1
    return [(i, partial[i]["conv_id"], nodes[i][1], partial[nodes[i][0]]["conv_id"] if i else None, partial[i]["n_convs"],
             children[i], leaves[i], saved[i], partial[i]["ends_sha256"] or NOTHING) for i in range(len(nodes))]


def trie(conversations: DataFrame, max_shards: int = MAX_SHARDS, sampled: int = SAMPLED) -> DataFrame:
    """A row for each node of the trie of the paths (id, path)."""
    spark = conversations.sparkSession
    grouped = written(conversations.groupBy("path", F.shiftright("id", BLOCK_BITS).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"),
        F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ",").alias("ids")), "paths")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(max_shards, 4 * partitions)
    sample = sorted(bytes(r.s) for r in grouped.select(F.expr(f"substring(path, 1, {SPLIT_DEPTH * PIECE})").alias("s"),
                                                       F.xxhash64("path", "block").alias("r"))
                    .orderBy("r").limit(sampled * shards).collect())
    splitters = sorted(set(sample[sampled - 1::sampled]) - {b""})
    child, nodes = skeleton(splitters)
    held = spark.sparkContext.broadcast((splitters, child))

    @F.pandas_udf("int")
    def shard(path: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(held.value[0], p) for p in path], dtype="int32")

    swept = written(grouped.withColumn("shard", shard("path")).repartition(partitions, "shard")
                    .sortWithinPartitions("path", "block").select("path", "n", "least", "ids")
                    .mapInPandas(_sweep(spark.sparkContext.broadcast(child)), NODE), "nodes")
    partial = {r.skeleton: r for r in swept.filter("skeleton IS NOT NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"))).collect()}
    combined = spark.createDataFrame(_combined(nodes, partial) if partial else [], "skeleton long, " + ", ".join(
        f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in RESULT))
    ids = F.broadcast(combined.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("_up")))
    finished = (swept.filter("skeleton IS NULL").join(ids, "parent_skeleton", "left")
                .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up")).select(RESULT))
    return finished.unionByName(combined.select(RESULT))


def conversation_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """A row for each node of the trie of all rebuilt conversations."""
    return trie(rebuilt(df.select(F.col(id_col).cast("long").alias("id"), F.col(turn_col).cast("long").alias("turn"),
                                  F.col(role_col).alias("role"), F.col(text_col).alias("text"))))


#: DuckDB: each prefix of each rebuilt conversation by its digest; crc32 as a fold over bits.
SQL = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS p, key, chars
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
      lambda x, b: list_reduce(list_prepend(xor(x, b), list_transform(range(8), lambda k: 0::BIGINT)),
          lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT v.c, t.p, t.key, t.chars FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND t.p <= v.h
  UNION ALL
  SELECT v.c, t.p, t.key, t.chars FROM convs v JOIN turns t ON t.c = v.c AND t.p > v.h),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, key, chars FROM rebuilt),
members AS (
  SELECT c, 0 AS d, 'root' AS node, NULL AS up, 0 AS chars FROM convs
  UNION ALL
  SELECT c, d, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY d), 'root') AS up, chars
  FROM (SELECT c, d, chars, md5(string_agg(key, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM placed)),
ends AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, arg_max(node, d) AS node FROM members GROUP BY c) GROUP BY node),
nodes AS (
  SELECT node, any_value(up) AS up, min(c) AS least, any_value(d) AS d, count(*) AS n, any_value(chars) AS chars
  FROM members GROUP BY node),
kids AS (SELECT up AS node, count(*) AS k FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT m.node, sum((x.n - 1) * x.chars) AS saved, sum(CASE WHEN k.k IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes x JOIN members m ON m.c = x.least AND m.d <= x.d LEFT JOIN kids k ON k.node = x.node GROUP BY m.node)
SELECT x.least AS conv_id, x.d::BIGINT AS depth, u.least AS parent_conv_id, x.n AS n_convs, coalesce(k.k, 0) AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes x JOIN below b ON b.node = x.node LEFT JOIN nodes u ON u.node = x.up
LEFT JOIN kids k ON k.node = x.node LEFT JOIN ends e ON e.node = x.node"""
