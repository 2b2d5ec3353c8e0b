import duckdb
import pytest

from . import brute
from fundlens.llm import quality

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_query_equals_sql_and_brute_force(spark, sf, documents):
    from fundlens.llm.queries import queries

    df = queries()["op7_quality"](spark, sf)
    assert df.columns == COLUMNS
    got = sorted(map(tuple, df.collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(con.execute(quality.SQL).fetchall())
    assert [r[:7] for r in got] == sorted((i, *brute.quality(t)) for i, t in documents)


def test_cases(edges, empty):
    got = sorted(map(tuple, quality.quality(edges).collect()))
    assert [r[:7] for r in got] == sorted((r.doc_id, *brute.quality(r.text)) for r in edges.collect())
    assert not any(r[-1] for r in got if r[-2])
    assert quality.quality(empty).count() == 0


def test_any_order_gives_the_same_verdicts(edges, monkeypatch):
    want = sorted(map(tuple, quality.quality(edges).collect()))
    for rules in (quality.RULES[::-1], quality.RULES[2:] + quality.RULES[:2]):
        monkeypatch.setattr(quality, "cascade_order", lambda *a, rules=rules: [(r, 1.0, 0) for r in rules])
        assert sorted(map(tuple, quality.quality(edges).collect())) == want


def test_a_rejected_document_costs_no_later_rule(spark, edges, monkeypatch):
    """The second rule's count fails wherever it is computed."""
    long = spark.createDataFrame([(n, f"plain words number {n} " * 20) for n in range(40)], "doc_id long, text string")
    monkeypatch.setattr(quality, "BASE_FAILED", "n_words < 0")
    monkeypatch.setitem(quality.RULE_COUNTS, "_fails", "cast(size(_l) div (size(_l) - size(_l)) as int)")
    first, second = quality.Rule("always", "n_words >= 0"), quality.Rule("fails", "_fails > 0")
    for docs in (long, edges):
        for order, fails in (([first, second], False), ([second, first], True)):
            monkeypatch.setattr(quality, "cascade_order", lambda *a, order=order: [(r, 1.0, 0) for r in order])
            if fails:
                with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
                    quality.quality(docs).collect()
            else:
                assert {r.kept for r in quality.quality(docs).collect()} == {False}


def test_rules_are_ordered_by_rejections_per_second(spark):
    docs = spark.createDataFrame([(n, "### *** word " * 60 if n % 2 else "plain words here " * 60) for n in range(50)],
                                 "doc_id long, text string")
    order = quality.cascade_order(docs)
    rates = [n / s for _, s, n in order]
    assert rates == sorted(rates, reverse=True) and max(n for _, _, n in order) == 50  # few distinct words
