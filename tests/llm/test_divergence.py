import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from . import brute
from fundlens.llm import divergence
from fundlens.llm.queries import oracle_sql, queries


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_brute_force_and_sql(spark, sf):
    docs = duckdb.sql(f"SELECT lang, source, text FROM '{sf}/documents.parquet'").fetchall()
    got = queries()["op12_source_divergence"](spark, sf)
    found = rows(got)
    assert found == brute.divergence(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    sql = con.execute(oracle_sql()["op12_source_divergence"])
    names = [c[0] for c in sql.description]
    assert sorted(tuple(r[names.index(c)] for c in got.columns) for r in sql.fetchall()) == found


def test_sorted_runs_hold_equal_terms():
    words = ["a", "abcdefgh", "abcdefghi", "abcdefgh", "x" * 64, "x" * 65, "x" * 64, "x" * 200, "x" * 200, "x" * 199 + "y", "é" * 40, "a", "é" * 40]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    data = divergence._CLEAN[data]
    starts, sizes, _ = divergence.pointers(data, np.array([0, len(data)]))
    run = divergence.sorted_runs(data, starts, sizes).tolist()
    assert len(run) == len(words)
    assert all((run[a] == run[b]) == (words[a] == words[b]) for a in range(len(words)) for b in range(len(words)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xy"), st.text(alphabet="aB é1漢\x00", max_size=30)), min_size=1, max_size=6))
def test_term_counts(docs):
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["l"] * len(docs)), pa.array([s for s, _ in docs]), pa.array([t for _, t in docs])],
                            names=["lang", "source", "text"])
    for at_once in (8, divergence.AT_ONCE):
        old, divergence.AT_ONCE = divergence.AT_ONCE, at_once
        try:
            got = [tuple(r.values()) for b in divergence._term_counts(iter([batch])) for r in b.to_pylist()]
        finally:
            divergence.AT_ONCE = old
        total, found = {}, {}
        for _, s, t, n, d in got:
            total[s, t] = total.get((s, t), 0) + n
            found[s, t] = found.get((s, t), 0) + d
        want, docs_of = {}, {}
        for s, t in docs:
            import re
            terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
            for x in terms:
                want[s, x] = want.get((s, x), 0) + 1
            for x in set(terms):
                docs_of[s, x] = docs_of.get((s, x), 0) + 1
        assert (total, found) == (want, docs_of)


def test_shares_are_exact():
    n = np.array([0, 1, 999_999_999_999, 5 * 10**13], dtype=np.int64)
    total = np.array([1, 3, 10**12 + 7, 7 * 10**13], dtype=np.int64)
    assert divergence.shares(n, total).tolist() == [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(n, total)]


def test_cases(spark, edges, empty):
    rows_in = [(i, r.text, lang, source, 1, "t", "n") for i, r in enumerate(edges.collect())
               for lang, source in (("en", "a"), ("en", "b"), (None, None), ("de", "a"))]
    rows_in += [(99, None, "xx", "only", 1, "t", "n"), (98, "", "xx", "other", 1, "t", "n")]
    df = spark.createDataFrame(rows_in, "doc_id long, text string, lang string, source string, n int, term string, docs string")
    got = rows(divergence.source_divergence(df))
    assert got == brute.divergence([(r[2], r[3], r[1]) for r in rows_in])
    assert ("xx", "only", "pair", "other", 0, 1) in got
    assert rows(divergence.source_divergence(df.limit(0))) == []
    assert rows(divergence.source_divergence(df, top=2)) == brute.divergence([(r[2], r[3], r[1]) for r in rows_in], 2)
