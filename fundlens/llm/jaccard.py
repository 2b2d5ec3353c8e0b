"""Similarity join of documents by the Jaccard similarity of their word shingles.

Two documents link when their sets of five words in a row are similar by 75
percent or more. Each set is held as 64-bit hashes; equal sets are one class
from the start, of which the least id stands for all.

1. Every class gets ``KEYS`` group keys, each of ``KEY_PARTS`` minimum hashes of its
   set. Two sets of similarity s share no key with probability
   (1 - s^KEY_PARTS)^KEYS, below 2e-12 at 75 percent, whatever their sizes.
2. In each group and size class, all are paired with one head (a star), and with
   that of the next smaller size class: first with the least id, then, where a
   group still holds several components, with a member that differs from group to group.
   Pairs whose signatures allow the similarity are verified on their texts. This ties
   a family of thousands of near copies together by a few pairs for each.
3. In each group that still holds several components, the members are joined by
   a signature tree (see ``signature_trees``), whose nodes are dropped as soon as they hold one
   component or cannot overlap enough. What remains is verified too.
   Groups above ``MAX_GROUP`` members are dealt as pairs of blocks to several tasks.

Verification brings the texts of a pair's two classes together by the least id of a
star, with many members split over several salts.

The links found so far tie components together; inside of one most pairs are not looked at.
As every link lies within a component, ``link_counts`` then counts the pairs of classes of each
component exactly. Its members are dealt by size class as blocks of ``MAX_BLOCK``
members and ``MAX_TOKENS`` shingles on average; pairs of blocks of one or two neighbouring size classes (no others
can link) go to tasks of their own, which return a count for each member and never a row for each pair. In a
family most members have most shingles: of a shingle that over half of a task's sets have, those without
it are counted instead.

Cases: a null or empty text, or one without words, has an empty set and
is linked with nothing (its component is its own id); with fewer than five words the whole
sequence is one shingle; texts are read whole; repeated rows and equal texts
are one class; a row with a null id links as any other and gets its component's least id that isn't null (null if
there is none); an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import signature_trees as trees
from .components import connected
from .rolling import FACTORS, _constants, mixed
from .shared import id_filter, key_id, row_key, written
from .words import shingle_sets

PERCENT = 75
SHINGLE = 5
#: Group keys of a class, and minimum hashes that make up each.
KEYS, KEY_PARTS = 50, 3
#: 64-bit numbers of a signature's bitmap.
BITMAP = 32
#: Rounds of stars, with other heads each, before the trees.
STAR_ROUNDS = 2
#: Members of a group that are joined in one task, and pairs of one star that a task verifies.
MAX_GROUP, MAX_STAR = 4096, 2000
#: Members and shingles of a block of a component whose links are counted, shingles and rows compared at a time, and
#: sets up to which the pairs that share a shingle are listed one by one.
MAX_BLOCK, MAX_TOKENS, COLUMNS, STRIP, FEW = 4096, 1 << 21, 1024, 1024, 48

PAIR = "a string, b string"
_FACTOR = _constants(11, KEYS * KEY_PARTS)
_SHIFT = _constants(12, KEYS * KEY_PARTS)


def group_keys(tokens: np.ndarray) -> np.ndarray:
    """The group keys of a set: each the hash of KEY_PARTS minimum hashes."""
    least = np.full(len(_FACTOR), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(tokens), 1024):
        part = tokens[at:at + 1024, None] ^ _SHIFT
        part *= _FACTOR
        np.minimum(least, part.min(axis=0), out=least)
    least = least.reshape(KEYS, KEY_PARTS)
    key = np.arange(1, KEYS + 1, dtype=np.uint64) * FACTORS[60]
    for n in range(KEY_PARTS):
        key = mixed(key ^ least[:, n]) * FACTORS[61]
    return key.view(np.int64)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The bits that a set's tokens set, as 64-bit numbers."""
    bits = np.zeros(BITMAP * 64, dtype=np.uint8)
    bits[(mixed(tokens ^ FACTORS[62]) % np.uint64(BITMAP * 64)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            b = batch.iloc[at:at + 500]
            rows = []
            seen: dict[tuple[int, int], tuple] = {}  # of copies only the first is worked out
            for i, s in zip(b["id"], shingle_sets(b["text"], SHINGLE), strict=True):
                own = (xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63), len(s))
                if own not in seen:
                    seen[own] = (group_keys(s), bitmap(s)) if len(s) else (None, None)
                rows.append((i, *own, *seen[own]))
            yield pd.DataFrame(rows, columns=["id", "content", "n", "keys", "bits"])


def _intersections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by star and kind; the star's own row is first."""
    star, own = None, None
    for batch in batches:
        for at in range(0, len(batch), 500):
            b = batch.iloc[at:at + 500]
            out = []
            for a, kind, i, s in zip(b["a"], b["kind"], b["id"], shingle_sets(b["text"], SHINGLE), strict=True):
                if kind == 0:
                    star, own = a, s
                elif a == star:
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if common and 100 * common >= PERCENT * (len(own) + len(s) - common):
                        out.append((a, i))
            yield pd.DataFrame(out, columns=["a", "b"])


def _joined():
    """Joins each group's members by a signature tree; rows come sorted by group."""

    def pairs(g: pd.DataFrame) -> list[tuple]:
        ids = g["id"].to_numpy()
        label = np.unique(g["label"].to_numpy(), return_inverse=True)[1]
        side = g["side"].to_numpy()
        order = np.lexsort((g["n"].to_numpy(), label, side))
        ids, side = ids[order], side[order]
        level = trees.items(np.array(g["bits"].tolist(), dtype=np.int64).view(np.uint64)[order],
                            g["n"].to_numpy(dtype=np.int64)[order], label[order].astype(np.int64))
        split = int(np.searchsorted(side, 1)) if side[-1] == 1 else None
        return [(ids[i], ids[j]) if ids[i] < ids[j] else (ids[j], ids[i])
                for x, y in trees.join(level, PERCENT, split) for i, j in zip(x.tolist(), y.tolist(), strict=True)]

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        for b in batches:
            b = b if left is None else pd.concat([left, b], ignore_index=True)
            key = b["key"].to_numpy()
            block = b["block"].to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
            starts = np.concatenate([[0], new]) if len(key) else np.array([], dtype=np.int64)
            found: set[tuple] = set()
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                found.update(pairs(b.iloc[s:e]))
            yield pd.DataFrame(list(found), columns=["a", "b"])
            left = b.iloc[int(starts[-1]):] if len(starts) else b
        if left is not None and len(left):
            yield pd.DataFrame(pairs(left), columns=["a", "b"])

    return sweep


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text), the id as a string that is never null: a row without one has its text's digest."""
    return df.select(row_key(F.col(id_col), F.col(text_col)).alias("id"), F.col(text_col).alias("text"), F.col(id_col).isNull().alias("without"))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of ``_keyed``, equal texts without an id once."""
    docs = _keyed(df, id_col, text_col)
    return docs.filter("not without").drop("without").unionByName(docs.filter("without").drop("without").dropDuplicates(["id"]))


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, content, n, keys, bits) of each document, written."""
    return written(_keyed(df, id_col, text_col).select("id", "text").mapInPandas(
        _signatures, "id string, content long, n long, keys array<long>, bits array<long>"), "signatures")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar, decided on the texts."""
    salts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).select(
        "a", F.ceil(F.col("c") / MAX_STAR).cast("int").alias("salts"))
    dealt = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    members = dealt.select(F.col("b").alias("id"), "a", "salt", F.lit(1).alias("kind"))
    own = dealt.select(F.col("a").alias("id"), "a", "salt", F.lit(0).alias("kind")).distinct()
    roles = members.unionByName(own)
    wanted = id_filter(roles.select("id"))
    return (docs.filter(wanted(F.col("id"))).join(roles, "id")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
            .select("a", "kind", "id", "text")
            .mapInPandas(_intersections, PAIR)
            .distinct())


def _size_class(n: Column) -> Column:
    """Sets that link are in one class or in two neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / PERCENT) + 1e-9).cast("int")


def links(df: DataFrame, sets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(a, b): links between classes that hold all classes' components together."""
    docs = _texts(df, id_col, text_col)
    # A class for each set; of documents with this set the least id stands for it.
    classes = written(sets.filter("n > 0").groupBy("content", "n")
                      .agg(F.min(F.struct("id", "keys", "bits")).alias("one"))
                      .select("one.id", "n", "one.keys", "one.bits"), "classes")
    keyed = classes.select("id", "n", F.explode("keys").alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    members = written(keyed.join(several, "key", "left_semi").withColumn("size_class", _size_class(F.col("n"))), "members")

    signs = classes.select("id", "n", "bits")
    labelled = members.withColumn("label", F.col("id"))
    tried, found = None, None
    for n_round in range(STAR_ROUNDS):
        # First the least id heads all its groups, then a member that depends on the group.
        rank = F.col("id") if not n_round else F.struct(F.xxhash64("id", "key"), F.col("id"))
        stars = _stars(labelled, rank)
        if tried is not None:
            stars = stars.join(tried, ["a", "b"], "left_anti")
        stars = written(_allowed(stars, signs), "stars")
        tried = stars if tried is None else tried.unionByName(stars)
        new = written(_verified(stars, docs), "links")
        found = new if found is None else found.unionByName(new)
        labelled = (members.join(connected(found), "id", "left")
                    .withColumn("label", F.coalesce("component", "id")).drop("component"))

    # Groups that hold several components by now.
    mixed_groups = (labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                                F.count(F.lit(1)).alias("c"))
                    .filter("x <> y").select("key", F.ceil(F.col("c") / MAX_GROUP).cast("int").alias("blocks")))
    rows = (labelled.join(mixed_groups, "key").join(signs.select("id", "bits"), "id")
            .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            # Block pairs (own, other): in the pair's task as its first or its second side.
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "n", "label", "bits"))
    rest = (rows.repartition("key", "block").sortWithinPartitions("key", "block")
            .mapInPandas(_joined(), PAIR).distinct().join(tried, ["a", "b"], "left_anti"))
    return found.unionByName(written(_verified(written(rest, "pairs"), docs), "links"))


def _stars(labelled: DataFrame, rank: Column) -> DataFrame:
    """Pairs (a, b) of each group's and size class's head, the first by rank, with the members of
    that and the next larger class, where sizes allow a link and labels differ."""
    heads = labelled.groupBy("key", "size_class").agg(
        F.min(F.struct(rank.alias("rank"), "id", "n", "label")).alias("head")).select("key", "size_class", "head")
    near = heads.unionByName(heads.select("key", (F.col("size_class") + 1).alias("size_class"), "head"))
    return (labelled.join(near, ["key", "size_class"]).filter("label <> head.label")
            .filter(f"100 * least(n, head.n) >= {PERCENT} * greatest(n, head.n)")
            .select(F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b")).distinct())


def _allowed(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs whose signatures allow the similarity."""
    signed = pairs
    for s in "ab":
        signed = signed.join(signs.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                                          F.col("bits").alias(f"bits_{s}")), s)

    def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x, y = (trees.items(np.array(b[f"bits_{s}"].tolist(), dtype=np.int64).view(np.uint64),
                                b[f"n_{s}"].to_numpy(dtype=np.int64), np.full(len(b), -1)) for s in "ab")
            every = np.arange(len(b))
            yield b.loc[trees.possible(x, every, y, every, PERCENT), ["a", "b"]]

    return signed.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInPandas(allowed, PAIR)


def _common(row: np.ndarray, count: np.ndarray, split: int | None, n: int) -> np.ndarray:
    """How many columns each two rows share; the rows of each column are listed one column after the other, ``count`` in each.

    Columns of few rows give their pairs one by one, those of many are multiplied as dense blocks.
    """
    a, b = (n, n) if split is None else (split, n - split)
    common = np.zeros((a, b), dtype=np.int32)
    begin = np.concatenate([[0], np.cumsum(count)])
    for size in np.unique(count[(count > 1) & (count <= FEW)]).tolist():
        own = begin[:-1][count == size]
        for at in range(0, len(own), max(1, (1 << 20) // size)):
            some = row[own[at:at + max(1, (1 << 20) // size), None] + np.arange(size)]  # ascending in each column
            for i in range(size):
                for j in range(i + 1, size):
                    x, y = some[:, i], some[:, j]
                    if split is None:
                        np.add.at(common, (x, y), 1)
                    else:
                        across = (x < split) & (y >= split)
                        np.add.at(common, (x[across], y[across] - split), 1)
    if split is None:
        common += common.T
    many = np.flatnonzero(count > FEW)
    for at in range(0, len(many), COLUMNS):
        own = many[at:at + COLUMNS]
        has = np.zeros((n, len(own)), dtype=np.float32)  # sums up to COLUMNS are exact
        for k, c in enumerate(own.tolist()):
            has[row[begin[c]:begin[c + 1]], k] = 1
        x, y = (has, has) if split is None else (has[:split], has[split:])
        for r in range(0, a, STRIP):
            common[r:r + STRIP] += (x[r:r + STRIP] @ y.T).astype(np.int32)
    return common


def similar(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """Whether each two sets link: all with all, or with ``split`` those before that place with those from it on."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    row = row[order]
    begin = np.concatenate([[0], np.cumsum(count)])
    # A shingle of over half of all sets is held by the few sets without it.
    usual = np.flatnonzero(2 * count > n)
    rows, counts = [], []
    lacking = np.zeros(n, dtype=np.int64)
    for c in usual.tolist():
        without = np.ones(n, dtype=bool)
        without[row[begin[c]:begin[c + 1]]] = False
        rows.append(np.flatnonzero(without))
        counts.append(len(rows[-1]))
        lacking += without
    base = len(usual)
    kept = np.ones(len(count), dtype=bool)
    kept[usual] = False
    rows = np.concatenate([row[np.repeat(kept, count)], *rows])
    counts = np.concatenate([count[kept], np.array(counts, dtype=np.int64)])
    # In common: unusual ones that both have, and usual ones but those that either lacks (not twice those that both do).
    both = _common(rows, counts, split, n)
    a = slice(None) if split is None else slice(split)
    b = slice(None) if split is None else slice(split, None)
    found = np.empty(both.shape, dtype=bool)
    for at in range(0, len(found), STRIP):
        strip = slice(at, at + STRIP)
        common = both[strip].astype(np.int64) + base - lacking[a][strip, None] - lacking[b][None, :]
        total = sizes[a][strip, None] + sizes[b][None, :]
        found[strip] = (common > 0) & (100 * common >= PERCENT * (total - common))
    if split is None:
        np.fill_diagonal(found, False)
    return found


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by component, block, side and id; repeated rows count once."""
    own, ids, sets, sides = None, [], [], []

    def done() -> pd.DataFrame:
        split = None if 0 in sides else sides.count(-1)  # a block with itself, or two
        if len(ids) < 2 or split in (0, len(ids)):
            return pd.DataFrame({"id": ids[:0], "n_links": []})
        found = similar(sets, split)
        counts = found.sum(axis=1) if split is None else np.concatenate([found.sum(axis=1), found.sum(axis=0)])
        return pd.DataFrame({"id": ids, "n_links": counts})

    for batch in batches:
        for at in range(0, len(batch), 500):
            b = batch.iloc[at:at + 500]
            out = []
            for c, block, side, i, s in zip(b["component"], b["block"], b["side"], b["id"],
                                            shingle_sets(b["text"], SHINGLE), strict=True):
                if (c, block) != own:
                    out.append(done())
                    own, ids, sets, sides = (c, block), [], [], []
                if not ids or ids[-1] != i:
                    ids.append(i)
                    sets.append(s)
                    sides.append(side)
            if any(map(len, out)):
                yield pd.concat([o for o in out if len(o)], ignore_index=True)
    if len(last := done()):
        yield last


def link_counts(df: DataFrame, classes: DataFrame, components: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_links): the other classes that each class (id, n) of a component (id, component) links with."""
    docs = _texts(df, id_col, text_col)
    members = written(classes.select("id", "n").join(components, "id").withColumn("size_class", _size_class(F.col("n"))), "members")
    blocks = members.groupBy("component", "size_class").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / MAX_BLOCK, F.sum("n") / MAX_TOKENS)).cast("long").alias("blocks"))
    # The blocks of the next smaller and the next larger class, where there are any.
    near = blocks
    for name, step in (("smaller", 1), ("larger", -1)):
        near = near.join(blocks.select("component", (F.col("size_class") + step).alias("size_class"), F.col("blocks").alias(name)),
                         ["component", "size_class"], "left")
    dealt = members.join(near, ["component", "size_class"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))

    def task(low: Column, across: bool, first: Column, second: Column, side: Column) -> Column:
        return F.struct(low.alias("low"), F.lit(across).alias("across"), first.alias("first"), second.alias("second"), side.alias("side"))

    own, cls, none = F.col("own"), F.col("size_class"), F.array().cast(
        "array<struct<low:int,across:boolean,first:bigint,second:bigint,side:int>>")
    each = lambda n, f: F.coalesce(F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), f)), none)
    tasks = F.concat(
        each(F.col("blocks"), lambda o: task(cls, False, F.least(own, o), F.greatest(own, o), F.signum(own - o).cast("int"))),
        each(F.col("larger"), lambda o: task(cls, True, own, o, F.lit(-1))),
        each(F.col("smaller"), lambda o: task(cls - 1, True, o, own, F.lit(1))))
    roles = dealt.select("component", "id", F.explode(tasks).alias("t")).select(
        "component", F.struct("t.low", "t.across", "t.first", "t.second").alias("block"), "t.side", "id")
    wanted = id_filter(members.select("id"))
    counts = (docs.filter(wanted(F.col("id"))).join(roles, "id").withColumn("block", F.to_json("block"))
              .repartition("component", "block").sortWithinPartitions("component", "block", "side", "id")
              .select("component", "block", "side", "id", "text").mapInPandas(_counts, "id string, n_links long"))
    return counts.groupBy("id").agg(F.sum("n_links").alias("n_links"))


def join_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> DataFrame:
    """One row per document: id, n_shingles, component_id, and if ``counted`` n_links: with how many
    other classes (different sets) the document's own links."""
    id_type = df.schema[id_col].dataType
    sets = signatures(df, id_col, text_col)
    found = links(df, sets, id_col, text_col)
    components = connected(found)
    own_id = key_id(F.col("id"), id_type)
    classes = sets.filter("n > 0").groupBy("content", "n").agg(F.min("id").alias("id"), F.min(own_id).alias("least"))
    named = written(classes.join(components, "id", "left").withColumn("component", F.coalesce("component", "id")), "named")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    if counted:
        named = named.join(link_counts(df, classes, components, id_col, text_col), "id", "left")
    more = ["n_links"] if counted else []
    return (sets.select("id", "content", "n").join(named.select("content", "n", "component_id", *more), ["content", "n"], "left")
            .select(own_id.alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(own_id).alias("component_id"),
                    *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in more)))


#: DuckDB: all sets as lists of shingles, links by a join on shingles, components by what can be reached.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words),
classes AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT c, c AS r FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a),
components AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c),
counts AS (SELECT a AS c, count(*) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(p.component_id, s.doc_id) AS component_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM sets s LEFT JOIN classes c ON c.s = s.s LEFT JOIN components p ON p.c = c.c LEFT JOIN counts k ON k.c = c.c"""
