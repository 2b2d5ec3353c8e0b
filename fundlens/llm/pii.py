"""Personal data: regular expressions propose spans, checksums confirm them,
context words adjust the score.

Base kinds (email, ip, card, phone) are kept whenever their own rule holds.
Further kinds (iban, ssn, bank card numbers of 13 digits, local phone numbers)
get a score: what the pattern alone is worth, plus what a valid checksum and a
nearby context word add. They are kept from ``MIN_SCORE`` on.

An IBAN ends where its country's length is reached, at a border of its groups, so a word or number
after it isn't taken with it; else its longest run counts, and for a country without a listed length every border
(the longest first) that mod 97 confirms. A card number of 13 digits ends at its own last group, whatever follows.

Cases: a null or empty text has no spans; texts are read whole, in time linear
in their length; equal rows give equal results; an empty table gives an empty
result; other columns are passed over; a null id is returned as any other. Spans are code points, end exclusive.
Spans of different kinds may overlap, spans of one kind never do.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which ties of start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn", "card13", "tel")
KINDS = BASE_KINDS + EXTRA_KINDS

# What a pattern, a valid checksum and a context word are worth.
PATTERN_SCORE = {"iban": 0.3, "ssn": 0.4, "card13": 0.1, "tel": 0.2}
CHECKSUM_SCORE = {"iban": 0.6, "card13": 0.4}
CONTEXT_SCORE = 0.3
MIN_SCORE = 0.7
#: Characters on either side of a span in which a context word counts.
CONTEXT_CHARS = 40

# Context words of each kind.
CONTEXT_WORDS = {
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "card13": ("card", "credit", "visa", "payment", "karte", "carte", "tarjeta"),
    "tel": ("tel", "phone", "call", "mobile", "fax", "telefon", "telephone", "telefono"),
}

# Characters of an IBAN by country (ISO 13616 registry).
IBAN_LENGTH = {
    code: n for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
        33: "RU"}.items() for code in codes.split()}

Span = tuple[int, str, int, float]

_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is taken whole, so starting inside one finds nothing new.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_BORDER = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_CARD13 = re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12}(?![0-9])")
_MORE = re.compile(r"[ -][0-9]")
_TEL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_DIGITS = re.compile(r"[^0-9]+")
_CONTEXT = re.compile(r"(?<![a-z])(?:" + "|".join(w for ws in CONTEXT_WORDS.values() for w in ws) + r")(?![a-z])")


def luhn(digits: str) -> bool:
    """Luhn's check digit: every second digit from the right doubled, digit sums add up to tens."""
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 13616: the first four characters to the end, letters as 10 to 35, remainder 1."""
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each @ with all the local characters before it, if a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        if start < at and (m := _EMAIL_DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The base kinds, by start, then kind as listed."""
    found = [(a, "email", b, 1.0) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]  # zeros without end are still a part
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), "ip", m.end(), 1.0))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 38 and 14 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), "card", m.end(), 1.0))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((m.start(), "phone", m.end(), 1.0))
    return found


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Runs that mod 97 confirms, each up to the first of its possible ends."""
    at = 0
    while head := _IBAN_HEAD.search(text, at):
        start, at = head.start(), head.end()
        if not (run := _IBAN.match(text, start)):
            continue
        ends = [(e, e - start - text.count(" ", start, e)) for e in
                (m.start() for m in _BORDER.finditer(text, start + 15, run.end()))]
        if run.end() < len(text) and re.match("[A-Za-z0-9]", text[run.end()]):
            ends = [x for x in ends if x[0] < run.end()]
        ends = [x for x in reversed(ends) if x[1] >= 15]
        length = IBAN_LENGTH.get(text[start:start + 2])
        if length:
            ends = [x for x in ends if x[1] == length] + ends[:1]
        for end, _ in ends:
            if mod97(text[start:end]):
                yield start, end
                at = end
                break


def _cards13(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed numbers, those that nothing follows first; none overlaps an earlier one."""
    found, at = [], 0
    while m := _CARD13.search(text, at):
        if luhn(_DIGITS.sub("", m[0])):
            found.append((bool(_MORE.match(text, m.end())), m.start(), m.end()))
        at = m.start() + 1
    taken, used = [], set()
    for _, start, end in sorted(found):
        if used.isdisjoint(range(start, end)):
            taken.append((start, end))
            used.update(range(start, end))
    yield from sorted(taken)


def extra_spans(text: str) -> list[Span]:
    """Kinds beyond the base, with their scores."""
    proposed = [(a, "iban", b, True) for a, b in _ibans(text)]
    proposed += [(m.start(), "ssn", m.end(), False) for m in _SSN.finditer(text)]
    proposed += [(a, "card13", b, True) for a, b in _cards13(text)]
    proposed += [(m.start(), "tel", m.end(), False) for m in _TEL.finditer(text)]
    found = []
    for start, kind, end, valid in proposed:
        if kind in CHECKSUM_SCORE and not valid:
            continue
        score = PATTERN_SCORE[kind] + CHECKSUM_SCORE.get(kind, 0.0) * valid
        near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
        words = set(_CONTEXT.findall(near.lower()))
        score += CONTEXT_SCORE * bool(words.intersection(CONTEXT_WORDS[kind]))
        # A context word of this kind just before, as a label, is worth as much again.
        label = text[max(0, start - 12):start].lower()
        score += CONTEXT_SCORE * any(w in label for w in CONTEXT_WORDS[kind])
        if score >= MIN_SCORE - 1e-9:
            found.append((start, kind, end, round(min(1.0, score), 2)))
    return found


_ORDER = {k: n for n, k in enumerate(KINDS)}


def _sorted(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], _ORDER[s[1]]))


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, each by start, then kind as listed."""
    if not text:
        return [], []
    base = base_spans(text)
    return _sorted(base), _sorted(base + extra_spans(text))


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping
    spans the first covers what it covers and the rest of a later one goes with it."""
    if not text:
        return text
    _, spans = find_spans(text)
    out, done = [], 0
    for start, kind, end, _ in spans:
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(out) + text[done:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end, _ in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_extra long, n_spans long"


def pii_columns(text):
    """Struct column FOUND of a text column."""

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, spans = find_spans(t)
            kinds = [s[1] for s in base]
            rows.append((*(kinds.count(k) for k in BASE_KINDS),
                         hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans) - len(base),
                         len(spans)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return found(text)


def redacted(text):
    """The text column without its personal data (see ``redact``); null stays null."""

    @F.pandas_udf("string")
    def red(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t) for t in texts], dtype=object)

    return red(text)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts of base kinds, digest of base spans, all spans."""
    return df.select(F.col(id_col), pii_columns(F.col(text_col)).alias("_p")).select(id_col, "_p.*")
