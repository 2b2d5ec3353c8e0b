"""Toxicity by weak supervision.

Voters say whether a word or a word beginning occurs (lexicons), or whether a
pattern of lexicon words and their surroundings does. Lexicon voters are mined
from labelled training rows; a fixed word list and patterns join them. A
generative label model, fitted by expectation maximisation, treats the true
label as unseen: it estimates how often each voter fires in either class, the
given label being one more fallible voter, and, from what is left over,
how voters correlate within a class; correlated voters share their say. A
linear (logistic) classifier is then trained on the posterior labels, from the
votes and hit counts alone, and scores every text.

The classifier is fitted on a bounded sample of labelled rows
(``TRAIN_ROWS``, those with the smallest hash of the id among the rows that are
not held out). Scoring covers every row.

Cases: a null or empty text is scored as a text in which no voter fires;
texts are read whole; equal texts get equal scores; rows of ``labels`` that
repeat an id count once, as toxic if any does; without training rows, or with
one class only, every score is the share of toxic training rows (0 without any);
an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that are used at most.
TRAIN_ROWS = 20_000
#: Lexicon voters at most, and candidates from which they are chosen.
MAX_VOTERS, MAX_CANDIDATES = 96, 4000
#: Letters of word beginnings that are candidates beside whole words.
STEMS = (4, 5, 6)
#: Of an entry's rows the toxic share, and of the toxic rows the entry's share, at least.
MIN_PRECISION, MIN_SHARE = 0.9, 0.01
THRESHOLD = 0.7

# Common English insults.
LEXICON = ("idiot moron stupid dumb loser scum trash garbage worthless pathetic disgusting clown imbecile fool "
           "jerk creep ugly filthy vermin bastard bitch shit fuck asshole crap retard freak").split()

WORD = re.compile(r"[^\W\d_]+")
_AIMED = re.compile(r"\b(?:you|your|u|he|she|they|these|those|this|that)\b[^.!?\n]{0,40}$")


def folds(id_col) -> tuple:
    """(held out?) of an id column: crc32 of the id as text, remainder 1 by 3."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def candidates(text: str) -> set[str]:
    """Whole words ("word") and word beginnings ("word*") of a text."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


@dataclass
class Voters:
    """Lexicon entries, each a word or (with a final *) a word beginning."""

    entries: list[str]

    def __post_init__(self) -> None:
        import ahocorasick

        self.fixed = len(self.entries)  # the fixed list's voter, then the patterns
        self.n = self.fixed + 3
        self.automaton = ahocorasick.Automaton()
        own: dict[str, list[tuple[int, bool]]] = {}
        for n, e in enumerate(self.entries):
            own.setdefault(e.rstrip("*"), []).append((n, not e.endswith("*")))
        for w in LEXICON:
            own.setdefault(w, []).append((self.fixed, True))
        for w, uses in own.items():
            self.automaton.add_word(w, (len(w), uses))
        self.automaton.make_automaton()

    def __reduce__(self):
        return Voters, (self.entries,)  # the automaton is built where it is used

    def hits(self, text: str | None) -> dict[int, int]:
        """How often each voter fires in a text."""
        out: dict[int, int] = {}
        text = (text or "").lower()
        size = len(text)
        spots: set[int] = set()
        for end, (length, uses) in self.automaton.iter(text):
            start = end + 1 - length
            if start and text[start - 1].isalpha():
                continue
            open_end = end + 1 < size and text[end + 1].isalpha()
            for voter, whole in uses:
                if not (whole and open_end):
                    out[voter] = out.get(voter, 0) + 1
                    spots.add(start)
        if spots:
            if len(spots) > 1:
                out[self.fixed + 1] = len(spots)  # repeated abuse
            aimed = sum(1 for s in spots if _AIMED.search(text[max(0, s - 60):s]))
            if aimed:
                out[self.fixed + 2] = aimed  # aimed at someone
        return out

    def features(self, rows: list[dict[int, int]]) -> np.ndarray:
        """Votes, the logarithm of all lexicon hits, and whether any voter fires."""
        x = np.zeros((len(rows), self.n + 2))
        for r, hits in enumerate(rows):
            for voter, n in hits.items():
                x[r, voter] = 1.0
                if voter <= self.fixed:
                    x[r, self.n] += n
        x[:, self.n] = np.log1p(x[:, self.n])
        x[:, self.n + 1] = x[:, :self.fixed + 1].any(axis=1)
        return x


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior P(toxic) of each row, by expectation maximisation.

    votes: rows by voters, 0 or 1; labels: the given ones, a voter like others.
    """
    # A voter that doesn't fire abstains; that none fires is a vote of its own.
    votes = np.column_stack([votes, ~votes.any(axis=1)]).astype(float)
    labels = labels.astype(float)
    posterior = np.clip(labels, 0.02, 0.98)

    def rates(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
        return (weights @ values + 0.5) / (weights.sum() + 1)

    def say(posterior: np.ndarray) -> np.ndarray:
        """The share that each voter has in what it says: of what is left of the voters in either class, those that go
        together share theirs."""
        rest = votes - np.outer(posterior, rates(posterior, votes)) - np.outer(1 - posterior, rates(1 - posterior, votes))
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        correlation = np.abs(rest.T @ rest / len(votes) / np.outer(spread, spread))
        np.fill_diagonal(correlation, 0)
        correlation[correlation < 0.2] = 0
        return 1 / (1 + correlation.sum(axis=0))

    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        said = votes @ (np.log(rates(posterior, votes) / rates(1 - posterior, votes)) * say(posterior))
        right, wrong = rates(posterior, labels), rates(1 - posterior, labels)
        told = labels * np.log(right / wrong) + (1 - labels) * np.log((1 - right) / (1 - wrong))
        logit = np.log(prior / (1 - prior)) + said + told
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done, posterior = np.abs(new - posterior).max() < 1e-6, new
        if done:
            break
    return posterior


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty), x.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray | None  # null: every score is ``rate``
    rate: float = 0.0

    def scores(self, texts) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.rate)
        x = self.voters.features([self.voters.hits(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _family(texts: pd.Series) -> pd.Series:
    """The least hash of five words in a row, which near copies mostly share; of fewer words, of all."""
    out = []
    for t in texts:
        words = (t or "").lower().encode("utf-8", "surrogatepass").split()
        out.append(min(zlib.crc32(b" ".join(words[n:n + 5])) for n in range(max(1, len(words) - 4))))
    return pd.Series(out)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, clean = Counter(), Counter()
    for b in batches:
        for text, label in zip(b["_text"], b["_toxic"], strict=True):
            (toxic if label else clean).update(candidates(text or ""))
    # A candidate that no toxic row of this task has says nothing for the class.
    names = list(toxic | clean)
    yield pd.DataFrame({"entry": pd.Series(names, dtype=object), "toxic": [toxic[e] for e in names], "clean": [clean[e] for e in names]})


def least_support(n_entries: int, rate: float) -> int:
    """Toxic rows that an entry must occur in, so that not one of all entries
    is expected to occur in only toxic rows by chance."""
    return max(3, math.ceil(math.log(2 * max(n_entries, 1)) / math.log(1 / min(max(rate, 1e-6), 0.5))))


def choose(found: list[tuple[str, int, int]], max_voters: int = MAX_VOTERS) -> list[str]:
    """Of (entry, toxic rows, clean rows) the entries that fire most, no two of them beginnings of each other."""
    chosen: list[str] = []
    # Of equal firings the longest beginning, then the whole word.
    for entry, _, _ in sorted(found, key=lambda f: (3 * f[2] - f[1], -len(f[0]), f[0])):
        word = entry.rstrip("*")
        if len(chosen) < max_voters and not any(
                word.startswith(c.rstrip("*")) or c.startswith(word) and entry.endswith("*") for c in chosen):
            chosen.append(entry)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """The model of the training rows: those of ``labels`` that are not held out."""
    key = F.col(id_col)
    chosen = (labels.filter(~folds(key) & F.col(label_col).isNotNull())
              .groupBy(key.alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    # At most train_rows pairs of numbers are broadcast. Of near copies one teaches as much as all.
    train = (docs.select(key.alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
             .withColumn("_family", F.pandas_udf(_family, "long")("_text")).dropDuplicates(["_family", "_toxic"])
             .select("_text", "_toxic").persist(StorageLevel.MEMORY_AND_DISK))
    try:
        n, positive = train.agg(F.count(F.lit(1)), F.sum("_toxic")).first()
        if not n or not positive or positive == n:
            return Model(Voters([]), None, float(positive or 0) / n if n else 0.0)
        counts = (train.mapInPandas(_counted, "entry string, toxic long, clean long")
                  .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                  .filter(F.col("toxic") >= 2).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            support = max(least_support(counts.count(), positive / n), math.ceil(MIN_SHARE * positive))
            found = (counts.filter((F.col("toxic") >= support)
                                   & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean"))))
                     .orderBy(F.desc(F.col("toxic") - 3 * F.col("clean")), "entry").limit(MAX_CANDIDATES).collect())
        finally:
            counts.unpersist()
        voters = Voters(choose([tuple(r) for r in found]))

        def voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                hits = [voters.hits(t) for t in b["_text"]]
                yield pd.DataFrame({"voter": [list(h) for h in hits], "n": [list(h.values()) for h in hits],
                                    "toxic": b["_toxic"]})

        # A short list of numbers for each of at most train_rows rows.
        rows = train.mapInPandas(voted, "voter array<int>, n array<int>, toxic int").collect()
    finally:
        train.unpersist()
    given = np.array([r["toxic"] for r in rows])
    x = voters.features([dict(zip(r["voter"], r["n"], strict=True)) for r in rows])
    posterior = label_model(x[:, :voters.n], given)
    return Model(voters, logistic(x, posterior))


def score(text, model: Model):
    """Column of scores (0 to 1) of a text column."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(list(texts)))

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col)
    out = docs.select(F.col(id_col), folds(F.col(id_col)).alias("held_out"),
                      score(F.col(text_col), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
