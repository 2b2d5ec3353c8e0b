"""Divergence of the sources of each language by their terms, from sorted word-start pointers.

1. Word starts: over the bytes of an Arrow batch, A-Z lower-cased, each term is a pointer to its first byte. The
   pointers are sorted by what they point to, a slice of eight bytes at a time: all are sorted by their
   first slice, runs of equal slices by the next one, until every run holds one term (multikey quicksort with
   slices as its characters). Equal runs give occurrences and documents by source.
2. Counts are added up by language, term and source, and terms found in at least ``MIN_DOCS`` documents of a
   language are kept: a row for each, with its counts by source.
3. Shares: p = 1 + floor(SCALE (count + 1) / (N + V)), in whole numbers. The distance of two is
   floor((p - q)^2 / q).
4. Pairs of sources: each task adds up the distances of its own terms for all pairs of a language at once
   (terms that neither source has count too), and these sums are added up. Terms of a source: the ``TOP`` largest
   distances from the whole language among its over-used terms; only a task's ``TOP`` leave it.

What is held by the driver and by each task are the sources with their totals; the result has a row for each pair of them.
A task's sums for pairs are as many as the pairs of the result.

Cases: null text, language and source are empty strings; a text without terms counts for no term, but its
group is reported (with value 0 for its pairs where its language keeps no term); each row is a document,
also if it repeats another; texts are read whole, long ones in parts; ties of value go by the UTF-8 bytes
of the item; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
#: Bytes whose pointers are sorted at a time; a longer text is cut between words.
AT_ONCE = 1 << 22
#: Bytes of a slice, and slices by which runs are split before what is left of them is compared as a whole.
SLICE, SLICES = 8, 8
#: Numbers of a block of terms by sources.
BLOCK = 1 << 18

COUNTED = "lang string, source string, term string, n long, docs long"

# What a byte is as part of a term: 0 if it is none, letters A-Z lower-cased.
_CLEAN = np.zeros(256, dtype=np.uint8)
_CLEAN[128:] = np.arange(128, 256)
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[65:91] = np.arange(97, 123)


def pointers(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, length and text of each term in cleaned bytes, given each text's begin and the last one's end."""
    term = data != 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[begins] = True
    starts = np.flatnonzero(term & (edge[:-1] | ~np.concatenate([[False], term[:-1]])))
    ends = np.flatnonzero(term & (edge[1:] | ~np.concatenate([term[1:], [False]]))) + 1
    return starts, ends - starts, np.searchsorted(begins, starts, side="right") - 1


def sorted_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The run of each pointer: equal numbers for equal terms."""
    padded = np.concatenate([data, np.zeros(SLICE, dtype=np.uint8)])
    places = np.ndarray((len(data) + 1,), dtype=">u8", buffer=padded.data, strides=(1,))
    run = np.zeros(len(starts), dtype=np.int64)
    left, used = np.arange(len(starts)), 0
    for depth in range(SLICES):
        if not len(left):
            return run
        rest = np.clip(sizes[left] - SLICE * depth, 0, SLICE)
        slices = places[np.minimum(starts[left] + SLICE * depth, len(data))].astype(np.uint64)
        unused = (8 * (SLICE - rest)).astype(np.uint64)
        slices = np.where(rest > 0, slices >> np.minimum(unused, np.uint64(63)) << np.minimum(unused, np.uint64(63)), np.uint64(0))
        order = np.lexsort((slices, run[left])) if depth else np.argsort(slices, kind="stable")
        own, slices = run[left][order], slices[order]
        new = np.concatenate([[0], np.cumsum((own[1:] != own[:-1]) | (slices[1:] != slices[:-1]))])
        run[left[order]] = used + new
        used += int(new[-1]) + 1
        left = left[rest == SLICE]  # their runs have no ended term
    whole: dict[tuple[int, bytes], int] = {}
    for k in left.tolist():
        s = int(starts[k])
        run[k] = used + whole.setdefault((int(run[k]), data[s + SLICE * SLICES:s + int(sizes[k])].tobytes()), len(whole))
    return run


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The terms at some pointers as strings."""
    ends = np.cumsum(sizes)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()),
                                       pa.py_buffer(data[place].tobytes()))


def _counted(data: np.ndarray, begins: np.ndarray, group: np.ndarray):
    """(term strings, group, occurrences, documents) of some texts, by term and group."""
    data = _CLEAN[data]
    starts, sizes, text = pointers(data, begins)
    if not len(starts):
        return None
    run = sorted_runs(data, starts, sizes)
    order = np.lexsort((group[text], run))  # stable: a text's own pointers stay together
    run, of, text = run[order], group[text[order]], text[order]
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (of[1:] != of[:-1])])
    heads = np.flatnonzero(new)
    documents = new | np.concatenate([[True], text[1:] != text[:-1]])
    first = order[heads]
    return (_gathered(data, starts[first], sizes[first]), of[heads], np.diff(np.append(heads, len(run))),
            np.add.reduceat(documents.astype(np.int64), heads))


def _cut(data: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text, cut where no term is."""
    at = 0
    while at < len(data):
        end = at + AT_ONCE
        while end < len(data):
            gaps = np.flatnonzero(_CLEAN[data[end:end + AT_ONCE]] == 0)
            if len(gaps):
                end += int(gaps[0])
                break
            end += AT_ONCE
        end = min(end, len(data))
        yield data[at:end]
        at = end


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def row_batch(names: list[tuple[str, str]], found) -> pa.RecordBatch:
        terms, group, n, docs = found
        lang, source = (pa.array([g[k] for g in names], pa.string()).take(pa.array(group)) for k in range(2))
        return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text")
        wide = pa.types.is_large_string(text.type)
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2], dtype=np.uint8) if text.buffers()[2] else np.empty(0, dtype=np.uint8)
        seen: dict[tuple[str, str], int] = {}
        group = np.array([seen.setdefault(g, len(seen)) for g in
                          zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)])
        names = list(seen)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + AT_ONCE, side="right")) - 1)
            own = data[offsets[at]:offsets[to]]
            if len(own) > AT_ONCE:  # one long text: its parts are one document
                total: Counter[str] = Counter()
                for part in _cut(own):
                    if found := _counted(part, np.array([0, len(part)]), np.zeros(1, dtype=np.int64)):
                        total.update(dict(zip(found[0].to_pylist(), found[2].tolist(), strict=True)))
                terms = list(total)
                for k in range(0, len(terms), 1 << 16):
                    some = terms[k:k + (1 << 16)]
                    yield row_batch(names, (pa.array(some, pa.string()), np.full(len(some), group[at]),
                                            [total[t] for t in some], np.ones(len(some), dtype=np.int64)))
            elif found := _counted(own, offsets[at:to + 1] - offsets[at], group[at:to]):
                yield row_batch(names, found)
            at = to


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE (n + 1) / total) for n + 1 <= total, exactly: three digits at a time."""
    out, rest = (n + 1) // total, (n + 1) % total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest %= total
    return out + 1


def _pair_sums(groups):
    """Sums of distances for all ordered pairs of sources of the languages, over the terms of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            order = np.argsort(np.array(langs, dtype=object), kind="stable") if langs else []
            for lang in dict.fromkeys(langs):
                sources, totals = groups.value[lang]
                own = pa.array([k for k in order if langs[k] == lang])
                size = max(1, BLOCK // len(sources))
                for at in range(0, len(own), size):
                    part = own[at:at + size]
                    names, counts = (batch.column(c).take(part) for c in ("sources", "counts"))
                    row = np.repeat(np.arange(len(part)), pc.list_value_length(names).to_numpy(zero_copy_only=False))
                    column = pc.index_in(names.flatten(), value_set=pa.array(sources, names.type.value_type)).to_numpy(zero_copy_only=False)
                    n = np.zeros((len(part), len(sources)), dtype=np.int64)
                    n[row, column] = counts.flatten().to_numpy(zero_copy_only=False)
                    p = shares(n, totals[None, :])
                    to = sums.setdefault(lang, np.zeros((len(sources), len(sources)), dtype=np.int64))
                    for a in range(len(sources)):
                        d = p[:, a:a + 1] - p
                        d *= d
                        d //= p
                        to[a] += d.sum(axis=0)
        for lang, found in sums.items():
            sources = groups.value[lang][0]
            for a, source in enumerate(sources):
                others = [b for b in range(len(sources)) if b != a]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(others), pa.string()), pa.array([source] * len(others), pa.string()),
                                                  pa.array([sources[b] for b in others], pa.string()),
                                                  pa.array(found[a, others], pa.int64())], names=["lang", "source", "item", "value"])

    return run


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE (count + 1) / total), exactly."""
    return 1 + F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)"))


def source_divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    spark = df.sparkSession
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                       for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counted = docs.mapInArrow(_term_counts, COUNTED).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = written(counted.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("at"), F.sum("docs").alias("docs"),
                                                        F.sum("n").alias("n"))
                    .filter(F.col("docs") >= min_docs)
                    .select("lang", "term", "n", F.col("at.source").alias("sources"), F.col("at.n").alias("counts")), "terms")
    by_source = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("a")).groupBy(
        "lang", F.col("a.sources").alias("source")).agg(F.sum("a.counts").alias("n"))
    by_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    groups = written(docs.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
                     .select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n"))), "groups")

    sources: dict[str, list] = {}
    for r in groups.orderBy("lang", "source").collect():
        sources.setdefault(r.lang, []).append((r.source, r.n + r.v))
    held = spark.sparkContext.broadcast({k: ([s for s, _ in v], np.array([t for _, t in v], dtype=np.int64)) for k, v in sources.items()})
    sums = terms.select("lang", "sources", "counts").mapInArrow(_pair_sums(held), "lang string, source string, item string, value long")
    other = groups.select("lang", F.col("source").alias("item"))
    every = groups.join(other, "lang").filter("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (sums.unionByName(every).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(group)))

    own = (terms.select("lang", F.col("term").alias("item"), F.col("n").alias("all"), F.explode(F.arrays_zip("sources", "counts")).alias("a"))
           .select("lang", F.col("a.sources").alias("source"), "item", "all", F.col("a.counts").alias("count"))
           .join(groups, ["lang", "source"])
           .withColumn("p", _share(F.col("count"), F.col("n") + F.col("v")))
           .withColumn("q", _share(F.col("all"), F.col("lang_n") + F.col("v")))
           .filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value")))
    best = own.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(columns)
            .unionByName(best.withColumn("part", F.lit("term")).select(columns)))


#: DuckDB: counts by a regular expression, all kept terms by all sources for the pairs.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_count FROM found GROUP BY ALL HAVING count(DISTINCT d) >= 3),
counts AS (
  SELECT f.lang, f.source, f.term, count(*) AS c FROM found f JOIN kept k ON k.lang = f.lang AND k.term = f.term GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_count) AS n FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN langs l ON l.lang = g.lang),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 1) // (g.n + g.v) AS p,
         1 + 1000000000 * (k.lang_count + 1) // (g.lang_n + g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM dense WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""
