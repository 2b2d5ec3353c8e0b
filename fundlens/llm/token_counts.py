"""Token counts under a unigram vocabulary, by dynamic programming on a trie.

A pre-token's best segmentation maximises the sum of its pieces' scores. The
best score of a prefix depends on the prefix alone, so the distinct
pre-tokens of a batch are put in a trie (here: walked in sorted order, where a
pre-token goes on from the prefix it shares with the one before it), the
forward scores are computed once for each node, and each terminal stores its
count. Documents then add up the counts of their pre-tokens.

The vocabulary is a public file of pieces in the order of their merges, whose
ranks stand in for log probabilities by Zipf's law. Scores are whole numbers,
so sums are exact in any order; of equal scores the fewest pieces win. A
character that no piece covers counts as its UTF-8 bytes, as byte fallback has it.

Pre-tokens: maximal runs without white space (space and \\x09 to \\x0D), each with
the word-start mark before it.

Cases: a null or empty text has no pre-tokens and no tokens; texts are read
whole; a pre-token of any length takes time linear in it; equal rows give
equal results; an empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Entries that a worker keeps of counted pre-tokens, of at most so many characters.
MAX_CACHED, MAX_CACHED_CHARS = 400_000, 64
#: Scores are log probabilities times this, rounded.
SCALE = 1 << 20
WORD = re.compile("[^ \x09-\x0d]+")

COUNTED = "n_pretokens long, n_tokens long"


def load_scores(path: str) -> dict[str, int]:
    """Whole-number log probabilities of the vocabulary's ordinary pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    # Pieces come in the order of their merges, single characters after them.
    total = sum(1 / (n + 2.7) for n in range(len(pieces)))
    return {p: round(-math.log((n + 2.7) * total) * SCALE) for n, p in enumerate(pieces)}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class TrieCounter:
    """Forward scores of pre-tokens, shared along common prefixes."""

    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        # A piece is matched from its end backwards, for as long as some piece ends so.
        self.endings = {p[n:] for p in scores for n in range(len(p))}
        self.bytewise = min(scores.values()) - SCALE
        self.known: dict[str, int] = {}

    def count(self, words: Iterable[str]) -> dict[str, int]:
        """The least number of tokens among the best segmentations of each word."""
        scores, endings = self.scores, self.endings
        before, best, out = "", [(0, 0)], {}
        for word in sorted(words):
            text = MARK + word
            shared, most = 0, min(len(before), len(text))
            while shared < most and before[shared] == text[shared]:
                shared += 1
            del best[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                top = (best[end - 1][0] + size * self.bytewise, best[end - 1][1] - size)
                start = end - 1
                while start >= 0 and (piece := text[start:end]) in endings:
                    score = scores.get(piece)
                    if score is not None:
                        s, n = best[start]
                        if (found := (s + score, n - 1)) > top:
                            top = found
                    start -= 1
                best.append(top)
            out[word] = -best[-1][1]
            before = text
        return out

    def texts(self, texts: Iterable[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        split = [Counter(WORD.findall(t)) if t else Counter() for t in texts]
        known = self.known
        new = {w for words in split for w in words if w not in known}
        counts = self.count(new)
        rows = []
        for words in split:
            tokens = 0
            for w, n in words.items():
                tokens += n * (counts[w] if w in counts else known[w])
            rows.append((sum(words.values()), tokens))
        if len(known) + len(counts) > MAX_CACHED:
            known.clear()
        if len(counts) <= MAX_CACHED:
            known.update((w, n) for w, n in counts.items() if len(w) <= MAX_CACHED_CHARS)
        return rows


_counters: dict[str, TrieCounter] = {}


def counter(path: str) -> TrieCounter:
    """One counter per worker process and vocabulary."""
    if path not in _counters:
        _counters[path] = TrieCounter(load_scores(path))
    return _counters[path]


def token_counts(text, path: str | None = None):
    """Struct column COUNTED of a text column."""
    path = path or default_vocabulary()

    @F.pandas_udf(COUNTED)
    def counted(texts: pd.Series) -> pd.DataFrame:
        rows, c = [], counter(path)
        for start in range(0, len(texts), 1000):  # bounds what a batch holds
            rows += c.texts(texts.iloc[start:start + 1000])
        return pd.DataFrame(rows, columns=["n_pretokens", "n_tokens"])

    return counted(text)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None) -> DataFrame:
    """One row per document: id, n_pretokens, n_tokens."""
    return df.select(F.col(id_col), token_counts(F.col(text_col), path).alias("_c")).select(id_col, "_c.*")
