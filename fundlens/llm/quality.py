"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule rejects a document by a condition on the text's own counts. The
counts that are returned are there for all; what a rule counts beyond them is
part of its own condition. The rules' cost and selectivity are measured on a sample that holds the
returned counts: each rule runs alone over it, timed, and its rejections are counted. The cascade then tries the
rules in the order of rejections per cost. The first that holds decides: a later rule's branch of
the CASE, and so its own counts, is not computed. No order changes a verdict.

Cases: a null or empty text has no words and fails the least-words rule; texts
are read whole; equal rows give equal results; an empty table gives an empty
result and keeps the rules' given order; only the id and text columns are
read, under names of their own, so further columns do no harm.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the sample on which cost and selectivity are estimated; it only sets the order.
SAMPLE_ROWS = 2000

# The white space between words (space, \x09 to \x0D) and the symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SPLIT = "[ \\t\\n\\x0B\\f\\r]+"

# Steps of columns as SQL; each may use those before it. What a lambda uses is
# a column of its own, so it is computed once a row.
_STEPS = [
    # Windows of three words as hashes with their place; the last two words start none.
    ("_g", "slice(transform(_w, (x, i) -> struct(xxhash64(x, get(_w, i + 1), get(_w, i + 2)) as h, i as i)),"
           " 1, greatest(size(_w) - 2, 0))"),
    # Only texts with a repeated window need them in order.
    ("_s", "case when size(array_distinct(_g.h)) < size(_g) then sort_array(_g) else slice(_g, 1, 0) end"),
    ("_d", "sort_array(transform(filter(_s, (x, k) -> get(_s, k - 1).h <=> x.h or get(_s, k + 1).h <=> x.h),"
           " x -> x.i))"),
]

# Counts of a text, as SQL over the steps' columns.
COUNTS = {
    "n_words": "cast(size(_w) as long)",
    "word_chars": "cast(char_length(translate(_t, _space, '')) as long)",
    "n_symbols": "cast(char_length(_t) - char_length(translate(_t, _symbols, '')) as long)",
    "n_dup_lines": "cast(size(_l) - size(array_distinct(_l)) as long)",
    # Each window covers three words; where two overlap, only the new ones count.
    "n_repeat_words": "cast(aggregate(transform(_d, (x, k) -> case when k = 0 then 3 else least(3, x - get(_d, k - 1))"
                      " end), 0, (a, x) -> a + x) as long)",
}
# Further counts that only the rules use, each where it is used.
RULE_COUNTS = {
    "_n_lines": "size(_l)",
    "_n_upper": "char_length(_t) - char_length(regexp_replace(_t, '[A-ZÀ-ÖØ-Þ]', ''))",
    "_n_lower": "char_length(_t) - char_length(regexp_replace(_t, '[a-zß-öø-ÿ]', ''))",
    "_n_distinct": "size(array_distinct(_w))",
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: str  # SQL over COUNTS and RULE_COUNTS


# The base rules, then the method's own.
BASE_RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
)
RULES = (
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 and 2 * n_dup_lines > _n_lines"),
    Rule("shouting", "_n_upper > _n_lower"),
    Rule("few_distinct", "20 * _n_distinct < n_words"),
)
BASE_FAILED = " or ".join(f"({r.rejects})" for r in BASE_RULES)


def condition(rule: Rule):
    """A rule's condition over COUNTS, with the further counts that it needs written out in it."""
    names = "|".join(map(re.escape, RULE_COUNTS))
    return F.expr(re.sub(rf"\b({names})\b", lambda m: f"({RULE_COUNTS[m[1]]})", rule.rejects))


def with_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id, COUNTS of the text, and what RULE_COUNTS are made of: the text, its words and lines."""
    out = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = out.withColumns({
        "_w": F.array_remove(F.split("_t", SPLIT), ""),
        "_space": F.lit(SPACE), "_symbols": F.lit(SYMBOLS),
        "_l": F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")})
    for name, sql in _STEPS:
        out = out.withColumn(name, F.expr(sql))
    return out.select("_id", "_t", "_w", "_l", *[F.expr(sql).alias(name) for name, sql in COUNTS.items()])


def cascade_order(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
                  sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, int]]:
    """Rules by rejections per second on a sample, each with its seconds and rejections."""
    n = df.count()
    every = max(1, n // max(sample_rows, 1))
    some = (df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_x"))
            .filter(F.pmod(F.xxhash64("_i"), F.lit(every)) == 0).coalesce(4))
    sample = with_counts(some, "_i", "_x").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not sample.count():
            return [(r, 0.0, 0) for r in rules]
        measured = []
        for rule in rules:
            began = time.perf_counter()
            rejected = sample.select(F.count_if(condition(rule))).first()[0]
            measured.append((rule, time.perf_counter() - began, rejected))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-6))


def cascade(rules: list[Rule]):
    """The name of the first rule that rejects, in the given order; null if none does."""
    verdict = F
    for n, rule in enumerate(rules):
        verdict = verdict.when(condition(rule), F.lit(rule.name))
    return verdict.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def quality(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: id, COUNTS, base_failed, kept."""
    order = [r for r, _, _ in cascade_order(df, rules, id_col, text_col, sample_rows)]
    base = F.expr(BASE_FAILED)
    return with_counts(df, id_col, text_col).select(
        F.col("_id").alias(id_col), *COUNTS, base.alias("base_failed"),
        F.when(base, F.lit(False)).otherwise(cascade(order).isNull()).alias("kept"))


# The same in DuckDB. \x0B is written by chr(), as it has no escape there.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)),
          lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM t),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM g, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1 GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w) AS n_words,
        length(regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
        length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
        length(t) - length(regexp_replace(t, '[a-zß-öø-ÿ]', '', 'g')) AS n_lower,
        len(list_distinct(w)) AS n_distinct
      FROM w LEFT JOIN r USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
    OR 100 * n_symbols > 10 * word_chars OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR (n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines) OR n_upper > n_lower OR 20 * n_distinct < n_words) AS kept
FROM c
"""
