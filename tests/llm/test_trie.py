import random

import duckdb
import pytest

from . import brute
from fundlens.llm import prefix_trie
from fundlens.llm.queries import oracle_sql, queries

COLUMNS = "conv_id long, turn long, role string, text string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same(got, want):
    assert rows(got) == sorted(want, key=str)


def test_query_equals_brute_force_and_sql(spark, sf):
    table = duckdb.sql(f"SELECT * FROM '{sf}/conversations.parquet'").fetchall()
    got = queries()["op11_conversation_trie"](spark, sf)
    same(got, brute.trie(table))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    found = con.execute(oracle_sql()["op11_conversation_trie"])
    assert [c[0] for c in found.description] == got.columns
    same(got, found.fetchall())


def family(n, seed):
    """Conversations that share turns, some of them copies, and one of many turns."""
    r, out = random.Random(seed), []
    for c in range(n):
        for t in range(r.choice((0, 1, 2, 3, 4, 9))):
            out.append((c, t, r.choice(("user", None)), r.choice(("a", "b", "", None, "ü😀"))))
    return out + [(n, t, "user", str(t % 7)) for t in range(300)]


@pytest.mark.parametrize("shards, sampled", [(1, 4), (7, 1), (64, 2)])
def test_shards_and_skeleton(spark, shards, sampled):
    table = family(700, shards)
    df = spark.createDataFrame(table, COLUMNS)
    plain = df.selectExpr("conv_id AS id", "turn", "role", "text")
    got = prefix_trie.trie(prefix_trie.rebuilt(plain), max_shards=shards, sampled=sampled)
    same(got, brute.trie(table))


def test_copies_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    table = [(100 * c, t, "user", f"turn {t}") for c in range(40) for t in range(3)]
    got = prefix_trie.conversation_trie(spark.createDataFrame(table, COLUMNS))
    same(got, brute.trie(table))
    assert got.count() == 4


def test_cases(spark):
    table = [(None, 0, "user", "left out"), (5, None, "user", "first"), (5, 0, "user", "tie"), (5, 0, "user", "tie"),
             (5, 0, "a", "tie"), (6, 0, None, None), (7, 0, "", ""), (123, 0, "user", "x" * 100_000), (100, 3, "a", "b"),
             (-7, 0, "user", "below zero"), (2**40, 0, "user", "large")]
    wide = spark.createDataFrame([(*r, "p", "q", 1) for r in table], COLUMNS + ", path string, id string, n int")
    same(prefix_trie.conversation_trie(wide), brute.trie([r for r in table if r[0] != -7 or True]))
    assert prefix_trie.conversation_trie(wide.limit(0)).count() == 0
    alone = prefix_trie.conversation_trie(wide.filter("conv_id = 6"))
    same(alone, brute.trie([(6, 0, None, None)]))
