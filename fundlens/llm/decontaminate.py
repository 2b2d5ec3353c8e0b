"""Benchmark items in documents, by CGK embeddings and bit-sampling LSH.

Texts are sequences of words. An item is found where a document's words differ
from it by at most ``MAX_EDITS`` of its length in word edits. Windows have the size of
an item and are placed where its runs of a few words occur: each edit touches ``RUN`` of
them at most, so of all its runs enough are left, near their places (those of
fewer, or too far apart, can't be an occurrence).

Windows and items are embedded by the random walk of Chakraborty, Goldenberg
and Koucky: at each step the walk copies the word that it stands on and
moves on or stays, by a random bit for step and word; a few edits then
change few steps. Each of several repetitions has a walk of its own over ``SPAN`` words, from its own place in the item and in
the window, and samples ``SAMPLED`` of its steps, all at which walks are still under way, as a key; windows that share a
key with an item of their size are candidates. As there is a window for each place at which an item's run was found, some
window is aligned with the item where a walk begins, however long the item and whatever was inserted before.
The repetitions follow from ``RECALL`` and the share of keys that stay equal at ``MAX_EDITS``, measured for
spans of each size. Candidates are verified by the exact edit distance of the item to any
stretch of the window and its surroundings.

Items are broadcast in blocks of ``BLOCK_BYTES`` at most on average; a larger benchmark
takes one pass over the documents for each block.

Cases: a null or empty text holds no item; texts are read whole; a
null item, or one without words, is not searched for; one of fewer than ``MIN_WORDS`` words is
searched for as a run of exactly these words; equal
items are each found; of equal distances the first place is given; repeated
documents each have rows of their own; empty tables give an empty result; other columns are
passed over. Words are lower-cased runs of ASCII letters and digits and of all
characters beyond ASCII; in scripts without spaces (``_UNSPACED``) each character is a word, and
their punctuation separates words.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rolling import FACTORS, _constants, mixed
from .shared import written
from .words import word_hashes

#: Word edits per word of an item.
MAX_EDITS = 0.25
#: Words of a run (two in short items).
RUN = 3
MIN_WORDS = 5
#: Sampled steps of a key, and the share of occurrences with the most edits that the keys of one aligned window find.
SAMPLED, RECALL = 3, 0.95
#: Words of an item that one walk goes over, and steps among which it is sampled, for each of these words.
SPAN, PACE = 24, 1.2
#: Spans with edits on which the share of equal keys is measured, and walks over each.
TRIALS, WALKS = 64, 48
BLOCK_BYTES = 1 << 24
#: Texts whose words are hashed, and windows that are embedded at a time.
AT_ONCE, MOST_WINDOWS = 500, 5000

_U = np.uint64
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[:128] = [not chr(c).isalnum() for c in range(128)]


# East Asian punctuation, and characters of Chinese, Japanese, Yi, Thai, Lao, Tibetan, Burmese, Khmer and Tai.
_PUNCTUATION = re.compile("[\u3000-\u3004\u3008-\u3020\u3030\u303d\u30a0\u30fb"
                          "\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]+")
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3005-\u3007\u3021-\u302f"
                       "\u3031-\u303c\u3041-\u30ff\u3100-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf"
                       "\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af])")


def _spaced(text: str | None) -> str:
    text = (text or "").lower()
    return text if text.isascii() else _UNSPACED.sub(r" \1 ", _PUNCTUATION.sub(" ", text))


def _words(texts) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([_spaced(t).encode("utf-8", "surrogatepass") for t in texts], SEPARATORS)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(len(words) - size + 1, 0), dtype=_U)
    for n in range(size):
        out += words[n:n + len(out)] * FACTORS[n]
    return mixed(out)


def embedded_keys(windows: np.ndarray, sizes: np.ndarray, repeats: int, sampled: int = SAMPLED) -> np.ndarray:
    """The keys of rows of words (zero beyond their sizes), a row for each
    repetition: sampled steps of its CGK walk from its own place on, at the same shares of each row's size."""
    n_rows = len(windows)
    share = (_constants(1000, repeats * (sampled + 1)) >> _U(11)).astype(np.float64).reshape(repeats, sampled + 1) / (1 << 53)
    padded = np.column_stack([windows, np.zeros(n_rows, dtype=_U)])
    repeat, row = np.repeat(np.arange(repeats), n_rows), np.tile(np.arange(n_rows), repeats)
    size = sizes[row]
    span = np.minimum(size, SPAN)
    at = (share[repeat, 0] * (size - span + 1)).astype(np.int64)
    steps = (share[repeat, 1:] * (PACE * span)[:, None]).astype(np.int64)
    last = int(steps.max(initial=-1))
    bits = _constants(5000, repeats * (last + 1)).reshape(repeats, last + 1)
    key = size.astype(_U)
    for step in range(last + 1):
        word = padded[row, at]
        here = np.flatnonzero((steps == step).any(axis=1))
        key[here] = mixed((key[here] ^ word[here]) * FACTORS[45])
        at = np.minimum(at + (mixed(word ^ bits[repeat, step]) >> _U(63)).astype(np.int64), size)
    return key.reshape(repeats, n_rows)


@cache
def equal_keys(span: int) -> float:
    """The share of keys that are equal for a span of different words and one with ``MAX_EDITS`` random edits to each word."""
    r = random.Random(span)
    rows = np.zeros((2 * TRIALS, span), dtype=_U)
    for k in range(TRIALS):
        words = list(range(1, 2 * span + 1))
        rows[k] = words[:span]
        for _ in range(int(MAX_EDITS * span)):
            n, what = r.randrange(span), r.randrange(3)
            words[n:n + (what != 1)] = [] if what == 2 else [r.getrandbits(40) + 1000]
        rows[TRIALS + k] = words[:span]
    keys = embedded_keys(mixed(rows), np.full(2 * TRIALS, span, dtype=np.int64), WALKS)
    return max(float((keys[:, :TRIALS] == keys[:, TRIALS:]).mean()), 1 / (TRIALS * WALKS))


def repetitions(size: int, recall: float = RECALL) -> int:
    """Keys after which an item of so many words with the most edits is found with ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - min(equal_keys(min(size, SPAN)), 0.99)))


def edit_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """The least edits from the item to any stretch of the words, and where the first such stretch ends."""
    n = len(item)
    places: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item.tolist()):
        places[w] |= 1 << i
    every, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = every, 0, n  # vertical differences +1 and -1 (Myers' bit vectors)
    best, end = n, 0
    for j, w in enumerate(words.tolist()):
        match = places.get(w, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & every
        plus, minus = (down | ~(diagonal | up)) & every, up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & every, minus << 1 & every
        up, down = (minus | ~(diagonal | plus)) & every, plus & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """Benchmark items with what is looked up of them."""

    def __init__(self, ids: list, texts: list[str | None], recall: float = RECALL):
        words, begins = _words(texts)
        few: dict[int, list[tuple[int, object]]] = defaultdict(list)
        self.ids, self.words, self.edits, self.runs, self.least = [], [], [], [], []
        for i, a, b in zip(ids, begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            n = b - a
            if n >= MIN_WORDS:
                k = int(MAX_EDITS * n)
                self.ids.append(i)
                self.words.append(words[a:b])
                self.edits.append(k)
                run = next(r for r in range(RUN, 0, -1) if r == 1 or n - r + 1 - r * k >= 2)
                self.runs.append(run)
                self.least.append(max(1, n - run + 1 - run * k))  # runs that k edits leave
            elif n:
                few[n].append((int(_runs(words[a:b], n)[0]), i))
        # Items of few words after the others: (hash, item), sorted, for each length.
        self.few: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, rows in few.items():
            rows.sort(key=lambda r: r[0])
            self.few[size] = (np.array([h for h, _ in rows], dtype=_U), len(self.ids) + np.arange(len(rows)))
            self.ids += [i for _, i in rows]
        # Runs of words: (hash, item, place), sorted, for each length.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted(set(self.runs)):
            found = [(h, i, o) for i, (w, r) in enumerate(zip(self.words, self.runs, strict=True)) if r == size
                     for o, h in enumerate(_runs(w, size).tolist())]
            found.sort()
            self.seeds[size] = (np.array([f[0] for f in found], dtype=_U), np.array([f[1] for f in found]),
                                np.array([f[2] for f in found]))
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.band = 2 * np.array(self.edits, dtype=np.int64) + 1
        self.least = np.array(self.least, dtype=np.int64)
        self.repeats = max((repetitions(int(n), recall) for n in np.unique(np.minimum(self.sizes, SPAN))), default=1)
        # Items by size, repetition and key.
        self.keys: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        rows = np.zeros((len(self.words), int(self.sizes.max(initial=1))), dtype=_U)
        for i, w in enumerate(self.words):
            rows[i, :len(w)] = w
        for r, keys in enumerate(embedded_keys(rows, self.sizes, self.repeats).tolist()):
            for i, key in enumerate(keys):
                self.keys[int(self.sizes[i]), r, key].append(i)

    def windows(self, words: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Distinct (text, first word, size) of the windows to look at."""
        out = []
        text_of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        for size, (hashes, item, place) in self.seeds.items():
            runs = _runs(words, size)
            if not len(runs):
                continue
            at = np.flatnonzero(text_of[:len(runs)] == text_of[size - 1:])
            low = np.zeros(1 << 20, dtype=bool)  # most runs are of no item
            low[(hashes & _U((1 << 20) - 1)).astype(np.int64)] = True
            at = at[low[(runs[at] & _U((1 << 20) - 1)).astype(np.int64)]]
            first = np.searchsorted(hashes, runs[at], "left")
            count = np.searchsorted(hashes, runs[at], "right") - first
            seed = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(at, count)
            own, text = item[seed], text_of[at]
            out.append(self._placed(own, text, at - place[seed], begins))
        return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 3), dtype=np.int64)

    def _placed(self, item: np.ndarray, text: np.ndarray, start: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """(text, first word, size) of seeds with enough others of their item close by."""
        band = start // self.band[item]  # occurrences span two neighbouring bands at most
        order = np.lexsort((band, text, item))
        item, text, band, start = item[order], text[order], band[order], start[order]
        new = np.ones(len(item), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (band[1:] != band[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(item)))
        gi, gt, gb = item[first], text[first], band[first]
        near = count.copy()
        beside = np.flatnonzero((gi[1:] == gi[:-1]) & (gt[1:] == gt[:-1]) & (gb[1:] == gb[:-1] + 1))
        near[beside] += count[beside + 1]
        near[beside + 1] = np.maximum(near[beside + 1], count[beside + 1] + count[beside])
        enough = near >= self.least[gi]
        keep = np.repeat(enough, count)
        item, text, start = item[keep], text[keep], start[keep]
        return np.column_stack([text, np.maximum(start, begins[text]), self.sizes[item]])

    def exact(self, words: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, word) of the items of few words, at their first place in a text."""
        text_of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        for size, (hashes, item) in self.few.items():
            runs = _runs(words, size)
            if not len(runs):
                continue
            first = np.searchsorted(hashes, runs, "left")
            hit = (hashes[np.minimum(first, len(hashes) - 1)] == runs) & (text_of[:len(runs)] == text_of[size - 1:])
            at = np.flatnonzero(hit)
            _, once = np.unique(np.column_stack([text_of[at], first[at]]), axis=0, return_index=True)
            for a in at[once].tolist():
                t, f = int(text_of[a]), int(first[a])
                for n in item[f:int(np.searchsorted(hashes, hashes[f], "right"))].tolist():
                    yield t, n, a - int(begins[t])

    def find(self, texts) -> list[dict[int, tuple[int, int]]]:
        """For each text the items in it: (edits, first word of the window)."""
        texts = list(texts)
        out: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        if not self.ids:
            return out
        most = max(self.edits, default=0)
        place: list[tuple[int, int, int]] = []  # text, first word, size
        around: list[np.ndarray] = []  # a window's words and those next to it
        for first in range(0, len(texts), AT_ONCE):
            words, begins = _words(texts[first:first + AT_ONCE])
            for t, i, s in self.exact(words, begins):
                out[first + t][i] = (0, s)
            for t, s, n in self.windows(words, begins).tolist():
                place.append((first + t, s - int(begins[t]), n))
                around.append(words[max(int(begins[t]), s - most):min(int(begins[t + 1]), s + n + most)].copy())
        for first in range(0, len(place), MOST_WINDOWS):
            self._verify(place[first:first + MOST_WINDOWS], around[first:first + MOST_WINDOWS], most, out)
        return out

    def _verify(self, place: list[tuple[int, int, int]], around: list[np.ndarray], most: int, out: list[dict]) -> None:
        sizes = np.array([n for _, _, n in place], dtype=np.int64)
        rows = np.zeros((len(place), int(sizes.max())), dtype=_U)
        for w, ((_, s, n), words) in enumerate(zip(place, around, strict=True)):
            own = words[min(s, most):][:n]
            rows[w, :len(own)] = own
        near: set[tuple[int, int]] = set()
        for r, keys in enumerate(embedded_keys(rows, sizes, self.repeats).tolist()):
            for w, key in enumerate(keys):
                for i in self.keys.get((place[w][2], r, key), ()):
                    near.add((w, i))
        for w, i in sorted(near):
            t, s, n = place[w]
            if out[t].get(i, (n, 0))[0] == 0:
                continue  # found without an edit further in front
            before, k = min(s, most), self.edits[i]
            edits, _ = edit_distance(self.words[i], around[w][max(before - k, 0):before + n + k])
            if edits <= k and (edits, s) < out[t].get(i, (n, 0)):
                out[t][i] = (edits, s)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[Items]:
    """The items, a block at a time."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).orderBy("i", "t").collect()
        yield Items([r["i"] for r in rows], [r["t"] for r in rows])


def find_items(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item in it: id, item, edits, word_at (the window's first word)."""
    out_type = T.StructType([T.StructField("id", df.schema[id_col].dataType),
                             T.StructField("item", benchmark.schema[item_col].dataType),
                             T.StructField("edits", T.LongType()), T.StructField("word_at", T.LongType())])
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sc = df.sparkSession.sparkContext
    parts: list[DataFrame] = []
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        held = sc.broadcast(items)

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame(
                    [(i, held.value.ids[n], *where) for i, found in zip(b["id"], held.value.find(b["text"]), strict=True)
                     for n, where in found.items()], columns=["id", "item", "edits", "word_at"])

        found = docs.mapInPandas(search, out_type)
        if parts:  # of several blocks, one at a time is held
            found = written(found, "items")
        parts.append(found)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "edits", "word_at")


def _holds(items: Broadcast):
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(f) for f in items.value.find(texts)], dtype=bool)

    return F.pandas_udf(search, "boolean")


def without_items(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows in whose text no item of the benchmark occurs."""
    sc, out = df.sparkSession.sparkContext, df
    for n, items in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        if n:  # of several blocks, one at a time is held
            out = written(out, "clean")
        out = out.filter(~_holds(sc.broadcast(items))(F.col(text_col)))
    return out
