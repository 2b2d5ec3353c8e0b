"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

The encoding of a byte string is the only chain of vocabulary tokens whose
adjacent pairs each encode to themselves. So the encodings of all prefixes
form a tree: the last token of a prefix is the vocabulary token that ends
there and is compatible with the last token before it. The transducer reads
one byte at a time and keeps, for every position where a later token may still
start, the tokens chosen since the last output. What all of these have in
common is emitted: no later byte can change it, and no token is longer than
the vocabulary's longest, so the lookahead is bounded. States are built when
first reached (lazy determinisation) and transitions are remembered.

Decoding runs an incremental UTF-8 state machine over the tokens' bytes: a
state is the unfinished tail of a character (at most three bytes), and the
step of a (state, token) pair is remembered too.

Cases: a null text encodes like an empty one (no tokens, the digest of the
empty string); texts of any length are read whole; equal rows give equal
results; an empty table gives an empty result; only the id and text columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Entries that a worker keeps of states, some 500 bytes each with their transitions, and, unless another number is
#: given for these, of encoded words, half of that. Fewer cost time, as what is forgotten is worked out again.
MAX_CACHED = 500_000
INF = float("inf")
#: A space beside other white space, or at an end of the text.
BESIDE_SPACE = re.compile(r"^\s|\s$| \s|\s ")

ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_chars_decoded long"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def merge_bytes(ranks: dict[bytes, int], piece: bytes, below: float = INF) -> list[bytes]:
    """Textbook BPE of a short string with the merges of a rank below ``below``."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            if (r := ranks.get(parts[i] + parts[i + 1], INF)) < best:
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """A byte-to-token transducer whose states are made on demand."""

    def __init__(self, ranks: dict[bytes, int], max_cached: int = MAX_CACHED):
        self.ranks, self.max_cached = ranks, max_cached
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[int, tuple] = {}
        # A state: the bytes since the first live position, the live positions
        # in them, each with the tokens from the last output to it, and the
        # last token that was output if a live position directly follows it.
        start = (b"", ((0, ()),), None)
        self.states = [start]
        self.number = {start: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _forget(self) -> None:
        """Let go of the states that were made last, half of them or more: most texts need the ones made first."""
        kept = len(self.states)
        while True:
            kept = max(kept // 2, 1)
            self.steps = {k: s for k, s in self.steps.items() if k >> 8 < kept and s[0] < kept}
            if kept == 1 or len(self.steps) <= 2 * self.max_cached:
                break
        del self.states[kept:]
        self.number = {s: n for n, s in enumerate(self.states)}

    def _edges(self, token: int) -> tuple[list[tuple[bytes, float]], list[tuple[bytes, float]]]:
        """What stands at a token's left and right edge while it is being merged:
        byte strings, each with the rank of the merge that absorbs it."""
        if (known := self.edges.get(token)) is None:
            left, right = [(self.bytes_of[token], INF)], [(self.bytes_of[token], INF)]
            for edge, side in ((left, 0), (right, -1)):
                part, rank = self.bytes_of[token], token
                while len(part) > 1:
                    parts = merge_bytes(self.ranks, part, rank)
                    part = parts[side]
                    edge.append((part, rank))
                    rank = self.ranks[part]
            known = self.edges[token] = (left, right)
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` then ``b`` encode to exactly these two.

        They do unless some merge reaches across: a string that ends ``a`` for
        a while and one that starts ``b`` for a while join before either is
        absorbed on its own side (of equal merges, the left one comes first).
        """
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) > 4 * self.max_cached:
                self.pairs.clear()
            known, get = True, self.ranks.get
            for x, x_gone in self._edges(a)[1]:
                for y, y_gone in self._edges(b)[0]:
                    joined = get(x + y)
                    if joined is not None and joined < x_gone and joined <= y_gone:
                        known = False
            self.pairs[a, b] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        tail, live, before = self.states[state]
        tail += bytes((byte,))
        for at, path in live:
            token = self.ranks.get(tail[at:])
            last = path[-1] if path else before
            if token is not None and (last is None or self.compatible(last, token)):
                reached = (*path, token)
                break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        prefixes = self.prefixes
        kept = [x for x in live if tail[x[0]:] in prefixes]
        kept.append((len(tail), reached))
        n = 0
        if (cut := kept[0][0]) or kept[0][1]:
            first = min(kept[0][1], *[path for _, path in kept])
            last = max(kept[0][1], *[path for _, path in kept])
            for x, y in zip(first, last, strict=False):
                if x != y:
                    break
                n += 1
        out = reached[:n]
        rest = tuple([(at - cut, path[n:]) for at, path in kept])
        if all(path for _, path in rest):
            before = None  # no live position follows the output directly
        elif out:
            before = out[-1]
        new = (tail[cut:], rest, before)
        if len(self.states) > self.max_cached or len(self.steps) > 4 * self.max_cached:
            self._forget()  # and go on from the new state
            if (number := self.number.get(new)) is None:
                number = self.number[new] = len(self.states)
                self.states.append(new)
            return number, out
        if (number := self.number.get(new)) is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        self.steps[state << 8 | byte] = (number, out)
        return number, out

    def encode(self, piece: bytes) -> list[int]:
        state, out, steps = 0, [], self.steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
                steps = self.steps
            state, emitted = step
            if emitted:
                out += emitted
        out += self.states[state][1][-1][1]
        return out


class Decoder:
    """Tokens to text, a token at a time; a tail of up to three bytes waits for its rest."""

    def __init__(self, bytes_of: dict[int, bytes], max_cached: int = MAX_CACHED):
        self.bytes_of, self.max_cached = bytes_of, max_cached
        self.steps: dict[tuple[bytes, int], tuple[str, bytes]] = {}

    def _step(self, tail: bytes, token: int) -> tuple[str, bytes]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        text = machine.decode(tail + self.bytes_of[token])
        if len(self.steps) > self.max_cached:
            self.steps.clear()
        return self.steps.setdefault((tail, token), (text, machine.getstate()[0]))

    def stream(self, tokens: Iterable[int]) -> Iterator[str]:
        tail, steps = b"", self.steps
        for token in tokens:
            step = steps.get((tail, token)) or self._step(tail, token)
            text, tail = step
            if text:
                yield text
        if tail:
            yield tail.decode("utf-8", "replace")

    def decode(self, tokens: Iterable[int]) -> str:
        return "".join(self.stream(tokens))


class Recent:
    """The values of the keys used last, in two generations: when the young one is full it becomes the old one, and
    what the old one held goes. So a key in steady use is never forgotten."""

    def __init__(self, most: int):
        self.half = max(most // 2, 1)
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        """The value, or None; a value of the old generation is taken over into the young one."""
        if (value := self.young.get(key)) is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value


class Codec:
    """Pre-tokens of a pattern, each through the transducer; and back."""

    def __init__(self, path: str, pattern: str, max_cached: int = MAX_CACHED, max_words: int | None = None):
        self.transducer = Transducer(load_ranks(path), max_cached)
        self.decoder = Decoder(self.transducer.bytes_of, max_cached)
        self.pieces = regex.compile(pattern).findall
        # In this pattern a space between two other characters always starts a
        # pre-token, so what stands between such spaces can be encoded by itself.
        self.by_space = pattern == default_pattern()
        self.known = Recent(max_cached if max_words is None else max_words)

    def _encode(self, text: str) -> tuple[int, ...]:
        out: list[int] = []
        whole = self.transducer.ranks.get
        for piece in self.pieces(text):
            piece = piece.encode("utf-8", "surrogatepass")
            if (token := whole(piece)) is not None:
                out.append(token)
            else:
                out += self.transducer.encode(piece)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not self.by_space or not text or BESIDE_SPACE.search(text):
            return list(self._encode(text))
        parts = text.split(" ")
        out = list(self._encode(parts[0]))
        known = self.known
        for part in parts[1:]:
            ids = known.young.get(part)
            if ids is None and (ids := known.get(part)) is None:
                ids = self._encode(" " + part)
                if len(part) <= 64:
                    known.put(part, ids)
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return self.decoder.decode(ids)


_codecs: dict[tuple, Codec] = {}


def codec(path: str, pattern: str, max_cached: int = MAX_CACHED, max_words: int | None = None) -> Codec:
    """One codec per worker process, vocabulary and sizes."""
    key = (path, pattern, max_cached, max_words)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode_ids(text, path: str | None = None, pattern: str | None = None):
    """Column of token ids (array<int>) of a text column; null for a null text."""
    path, pattern = path or default_vocabulary(), pattern or default_pattern()

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([None if t is None else c.encode(t) for t in texts])

    return encoded(text)


def decode_ids(ids, path: str | None = None, pattern: str | None = None):
    """Column of text from token ids; bytes that are no UTF-8 become U+FFFD."""
    path, pattern = path or default_vocabulary(), pattern or default_pattern()

    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([None if r is None else c.decode(int(i) for i in r) for r in rows])

    return decoded(ids)


def encoding_digest(text, path: str | None = None, pattern: str | None = None, max_cached: int = MAX_CACHED,
                    max_words: int | None = None, kept: bool = True):
    """Struct column ENCODED: a text is encoded, its ids decoded again, both digested.

    The ids themselves stay in the task, so a text of any length costs the
    same few bytes downstream. Unless ``kept``, each task has a codec of its own and
    lets go of it at its end, so that the worker's next tasks, of whatever stage, have the memory.
    """
    path, pattern = path or default_vocabulary(), pattern or default_pattern()

    @F.pandas_udf(ENCODED)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = (codec if kept else Codec)(path, pattern, max_cached, max_words)
        for texts in batches:
            rows = []
            for t in texts:
                ids = c.encode(t or "")
                back = c.decode(ids)
                rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), len(back)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_chars_decoded"])

    return digest(text)


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, n_chars_decoded."""
    return df.select(F.col(id_col), encoding_digest(F.col(text_col), path, pattern).alias("_e")).select(
        id_col, "_e.*")
