"""Repeated byte strings of all documents, by a depth-limited radix sort of suffixes.

Suffixes need only be ordered through their first ``length`` bytes: those that
are equal there are the repeated windows. Most-significant-digit passes
separate them, and a group of one is done with:

1. Digit one is a window's anchor, the string of ``ANCHOR`` bytes in it with the
   smallest hash. Equal windows have equal anchors at equal places, and
   neighbouring windows mostly share theirs, so one row stands for a run of
   windows. A run whose anchor occurs once is done with.
2. Digit two is the whole text of the run. Runs of equal anchor and text are
   repeated in all their windows.
3. What is left, the different texts around one anchor, is brought together
   by anchor, a representative for each text. The windows are sorted by
   offset and content; equal neighbours are repeated.

Groups are counted before anything is joined, partial counts first. An anchor
with more than ``MAX_GROUP`` different texts is not brought together: its windows
are rows of their own then, counted by content. Texts cross the network only
for documents that a fixed-size filter lets through.

Hashes: an anchor is compared by 64 bits and its run by 64 further bits, a
window by its anchor's 64 and 64 further bits (128 where rows are counted).

Cases: a null text is an empty one; texts shorter than ``length`` have no
window; texts of any length are read whole, the longest in overlapping parts; ties
of the smallest hash go to the leftmost; a repeated row is one more document
with the same text, so it is removed where it is long enough (rows that share
an id and differ in text share what is found in either); a row with a null id is a document of its own
(rows without an id and of equal text repeat each other); an empty table gives
an empty result; other columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rolling import sliding_min, window_hashes
from .shared import id_filter, key_id, row_key, written

LENGTH = 200
#: Bytes of an anchor. Shorter: fewer rows, but more anchors that only look repeated.
ANCHOR = 48
#: Different texts around one anchor that are brought together in a task.
MAX_GROUP = 10_000
#: Bytes of text, and contexts, that are worked on at a time (each byte takes some 60 bytes of arrays).
CHUNK, CONTEXTS = 1 << 20, 4000
_POSITION = 26  # bits of a position in a chunk, which is shorter than that


def _chunks(rows: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in chunks: ids, bytes, where each text (or part) begins, and its place in its text."""
    ids: list = []
    parts: list[bytes] = []
    bases: list[int] = []
    size = 0

    def done():
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return ids, np.frombuffer(b"".join(parts), dtype=np.uint8), begins, np.array(bases, dtype=np.int64)

    for batch in rows:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass") if text.is_valid else b""
            for at in range(0, max(len(data) - length + 1, 0), CHUNK):
                part = data[at:at + CHUNK + length - 1]
                ids.append(i)
                parts.append(part)
                bases.append(at)
                size += len(part)
                if size >= CHUNK:
                    yield done()
                    ids, parts, bases, size = [], [], [], 0
    if parts:
        yield done()


def _runs(rows: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs of windows of one anchor: anchor's hash, run's hash, id, packed place."""
    for ids, data, begins, bases in _chunks(rows, length):
        hashes = window_hashes(data, ANCHOR)
        low = np.uint64((1 << _POSITION) - 1)
        keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        at = (sliding_min(keys, length - ANCHOR + 1) & low).astype(np.int64)  # each window's anchor
        text = np.repeat(np.arange(len(ids)), np.diff(begins))[:len(at)]
        windows = np.flatnonzero(np.arange(len(at)) + length <= begins[1:][text])  # whole in one text
        at, text = at[windows], text[windows]
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(windows)) - 1
        at, text, start, end = at[first], text[first], windows[first], windows[last]
        far, near = at - start, at - end  # of the anchor from the run's first and last window
        digest, view = xxhash.xxh3_64_intdigest, memoryview(data)
        runs = np.fromiter(
            (digest(view[s:e + length], seed=f << 8 | n) for s, e, f, n in
             zip(start.tolist(), end.tolist(), far.tolist(), near.tolist(), strict=True)), np.uint64, len(first))
        place = (at - begins[text] + bases[text]) << 16 | far << 8 | near
        names = pa.array([ids[t] for t in text.tolist()], type=schema.field("id").type)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[at].view(np.int64)), pa.array(runs.view(np.int64)), names, pa.array(place)], schema=schema)


def _unpacked(place: int) -> tuple[int, int, int]:
    """Anchor's position, its distance from the run's first window, and from the last."""
    return place >> 16, place >> 8 & 255, place & 255


def _contexts(length: int):
    """Cuts the texts of runs out of their documents."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text, runs in zip(b["id"], b["text"], b["runs"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                for r in runs:
                    at, far, near = _unpacked(r["place"])
                    out.append((r["h"], i, r["place"], r["n"] == 1, r["large"], data[at - far:at - near + length]))
            yield pd.DataFrame(out, columns=["h", "id", "place", "open", "large", "context"])

    return cut


def _spans_of(ids: list, places: list[int], flags: list[np.ndarray], length: int) -> list[tuple]:
    """(id, start, end) of each maximal row of flagged windows of a run."""
    out = []
    for i, place, flag in zip(ids, places, flags, strict=True):
        at, far, _ = _unpacked(place)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
        out += [(i, at - far + int(s), at - far + int(e) - 1 + length) for s, e in zip(edges[::2], edges[1::2], strict=True)]
    return out


def _repeated(length: int):
    """The repeated windows among the contexts of each anchor; rows come sorted by anchor."""

    def group(h: np.ndarray, context: list[bytes], place: list[int], ids: list, is_open: np.ndarray) -> pd.DataFrame:
        begins = np.concatenate([[0], np.cumsum([len(c) for c in context])]).astype(np.int64)
        hashes = window_hashes(np.frombuffer(b"".join(context), dtype=np.uint8), length)
        counts = np.diff(begins) - length + 1
        row = np.repeat(np.arange(len(context)), counts)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        content = hashes[begins[row] + offset]
        far = np.array([_unpacked(p)[1] for p in place])
        # Of one anchor, at one distance from it, and of equal content.
        _, anchor = np.unique(h, return_inverse=True)
        digit = anchor[row].astype(np.int64) << 8 | (far[row] - offset)
        order = np.lexsort((digit, content))
        same = (content[order[1:]] == content[order[:-1]]) & (digit[order[1:]] == digit[order[:-1]])
        repeated = np.zeros(len(row), dtype=bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        flags = np.split(repeated, np.cumsum(counts)[:-1])
        keep = [n for n in np.flatnonzero(is_open).tolist()]
        return pd.DataFrame(_spans_of([ids[n] for n in keep], [place[n] for n in keep], [flags[n] for n in keep], length),
                            columns=["id", "s", "e"])

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None  # the rows of the last anchor, which may go on in the next batch
        for b in batches:
            b = b if left is None else pd.concat([left, b], ignore_index=True)
            h = b["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1])) if len(h) else 0
            left = b.iloc[cut:]
            for part in _pieces(b.iloc[:cut]):
                yield group(part["h"].to_numpy(), list(part["context"]), list(part["place"]), list(part["id"]),
                            part["open"].to_numpy(dtype=bool))
        if left is not None and len(left):
            yield group(left["h"].to_numpy(), list(left["context"]), list(left["place"]), list(left["id"]),
                        left["open"].to_numpy(dtype=bool))

    return sweep


def _pieces(rows: pd.DataFrame, size: int = CONTEXTS) -> Iterator[pd.DataFrame]:
    """Sorted rows in pieces of about ``size`` that never part the rows of one anchor."""
    h, at = rows["h"].to_numpy(), 0
    while at < len(rows):
        end = min(at + size, len(rows))
        if end < len(rows):
            end = int(np.searchsorted(h, h[end - 1], side="right"))
        yield rows.iloc[at:end]
        at = end


def _single_windows(length: int):
    """Each window of a context as a row: its digest, id, start, and whether it is still open."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, place, is_open, context in zip(b["id"], b["place"], b["open"], b["context"], strict=True):
                at, far, near = _unpacked(place)
                out += [(xxhash.xxh3_128_digest(context[n:n + length]), i, at - far + n, is_open)
                        for n in range(far - near + 1)]
            yield pd.DataFrame(out, columns=["w", "id", "s", "open"])

    return split


def repeated_spans(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   max_group: int = MAX_GROUP) -> DataFrame:
    """(id, s, e): spans in bytes that cover exactly the repeated windows; they may overlap."""
    docs = df.select(row_key(F.col(id_col), F.col(text_col)).alias("id"), F.col(text_col).alias("text"))
    return _spans(docs, length, max_group).withColumn("id", key_id(F.col("id"), df.schema[id_col].dataType))


def _spans(docs: DataFrame, length: int, max_group: int) -> DataFrame:
    """(id, s, e) of documents (id, text) whose ids are row keys."""
    if length < ANCHOR or length - ANCHOR > 255:
        raise ValueError(f"length must be {ANCHOR} to {ANCHOR + 255}")
    kind = T.StringType()
    runs_type = T.StructType([T.StructField("h", T.LongType()), T.StructField("u", T.LongType()),
                              T.StructField("id", kind), T.StructField("place", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(runs_type)
    runs = docs.mapInArrow(lambda batches: _runs(batches, length, arrow), runs_type)

    # Pass 1: runs whose anchor occurs again.
    # Written, so that both sides of the join are shuffles that Spark can split where one anchor is hot.
    again = written(runs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "anchors")
    left = written(runs.join(again, "h", "left_semi"), "runs")
    # Pass 2: texts of runs, with how often they occur and one place.
    texts = written(left.groupBy("h", "u").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "place")).alias("one")),
                    "texts")
    equal = left.join(texts.filter("n > 1").select("h", "u"), ["h", "u"], "left_semi")
    place = F.col("place")
    whole = equal.select("id", (F.shiftright(place, 16) - F.shiftright(place, 8).bitwiseAND(255)).alias("s"),
                         (F.shiftright(place, 16) - place.bitwiseAND(255) + length).alias("e"))
    # Pass 3: anchors with different texts.
    several = (texts.groupBy("h").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least"))
               .filter("d > 1 and least = 1").select("h", (F.col("d") > max_group).alias("large")))
    open_runs = (texts.join(several, "h").select("one.id", F.struct("h", "one.place", "n", "large").alias("run"))
                 .groupBy("id").agg(F.collect_list("run").alias("runs")))  # of one document: within its length
    wanted = id_filter(open_runs.select("id"))
    contexts_type = T.StructType([
        T.StructField("h", T.LongType()), T.StructField("id", kind), T.StructField("place", T.LongType()),
        T.StructField("open", T.BooleanType()), T.StructField("large", T.BooleanType()),
        T.StructField("context", T.BinaryType())])
    contexts = written(docs.filter(wanted(F.col("id"))).join(open_runs, "id").select("id", "text", "runs")
                       .mapInPandas(_contexts(length), contexts_type), "contexts")
    spans_type = T.StructType([T.StructField("id", kind), T.StructField("s", T.LongType()),
                               T.StructField("e", T.LongType())])
    together = (contexts.filter("not large").repartition("h").sortWithinPartitions("h")
                .mapInPandas(_repeated(length), spans_type))
    windows = contexts.filter("large").mapInPandas(_single_windows(length), T.StructType(
        [T.StructField("w", T.BinaryType()), *spans_type.fields[:2], T.StructField("open", T.BooleanType())]))
    twice = windows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w")
    single = (windows.filter("open").join(twice, "w", "left_semi")
              .select("id", "s", (F.col("s") + length).alias("e")))
    return whole.unionByName(together).unionByName(single)


REMOVED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted((int(x["s"]), int(x["e"])) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def without_spans(text: str | None, spans) -> tuple[bytes, list[list[int]]]:
    """The bytes outside of the spans, and the spans merged into maximal runs."""
    data = (text or "").encode("utf-8", "surrogatepass")
    cuts = [[s, min(e, len(data))] for s, e in _merged(spans if spans is not None else ()) if s < len(data)]
    kept, at = [], 0
    for s, e in cuts:
        kept.append(data[at:s])
        at = e
    return b"".join(kept) + data[at:], cuts


def _removed(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, own in zip(texts, spans, strict=True):
        kept, cuts = without_spans(text, own)
        gone = sum(e - s for s, e in cuts)
        rows.append((len(kept) + gone, gone, len(cuts), hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in REMOVED.split(", ")])


def remove_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   max_group: int = MAX_GROUP) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = df.select(row_key(F.col(id_col), F.col(text_col)).alias("id"), F.col(text_col).alias("text"))
    own_id = key_id(F.col("id"), df.schema[id_col].dataType).alias(id_col)
    spans = written(_spans(docs, length, max_group), "spans")
    by_id = spans.groupBy("id").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    found = id_filter(spans.select("id"))
    marked = docs.withColumn("_found", found(F.col("id")))
    removed = F.pandas_udf(_removed, REMOVED)
    cut = (marked.filter("_found").join(by_id, "id", "left")
           .select(own_id, removed("text", "spans").alias("_r")).select(id_col, "_r.*"))
    # Documents that the filter leaves out have no span; their texts stay where they are.
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rest = marked.filter("not _found").select(
        own_id, F.octet_length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(data, 256).alias("kept_sha256"))
    return cut.unionByName(rest)


#: DuckDB: each string of 200 bytes by its digest, over texts as hexadecimal digits.
SQL = """
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT d, i, md5(substr(x, 2 * i + 1, 400)) AS w
  FROM (SELECT d, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM docs WHERE len(x) >= 400)),
starts AS (
  SELECT d, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
opened AS (
  SELECT d, i, CASE WHEN i <= lag(i) OVER (PARTITION BY d ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM starts),
runs AS (
  SELECT d, min(i) AS a, max(i) + 200 AS b FROM (
    SELECT d, i, sum(new) OVER (PARTITION BY d ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM opened) GROUP BY d, run),
pieces AS (
  SELECT d, a, b, coalesce(lag(b) OVER (PARTITION BY d ORDER BY a), 0) AS after FROM runs),
kept AS (
  SELECT p.d, sum(b - a) AS gone, count(*) AS n, max(b) AS last,
         string_agg(substr(o.x, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS parts
  FROM pieces p JOIN docs o ON o.d = p.d GROUP BY p.d)
SELECT o.doc_id, len(o.x) // 2 AS n_bytes, coalesce(k.gone, 0)::BIGINT AS n_removed, coalesce(k.n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(k.parts || substr(o.x, 2 * k.last + 1), o.x))) AS kept_sha256
FROM docs o LEFT JOIN kept k ON k.d = o.d"""
