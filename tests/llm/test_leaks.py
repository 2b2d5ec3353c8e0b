import random

import numpy as np
import pytest

from . import brute
from fundlens.llm import decontaminate as D
from fundlens.llm.rolling import mixed


def test_edit_distance():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randint(0, 4) for _ in range(n)] for n in (r.randint(1, 12), r.randint(0, 20)))
        assert D.edit_distance(np.array(a), np.array(b))[0] == brute.stretch_distance(a, b)


def planted(documents, items, seed, edits):
    r, words = random.Random(seed), " ".join(t for _, t in documents[:50]).split()
    for i, t in items:
        own = t.split()
        for _ in range(int(edits * len(own))):
            n, what = r.randrange(len(own)), r.randrange(3)
            own[n:n + (what != 1)] = [] if what == 2 else [r.choice(words)]
        around = r.choice(documents)[1].split()
        cut = r.randint(0, len(around))
        yield i, " ".join(around[:cut] + own + around[cut:])


def benchmark(sf):
    import duckdb

    return duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()


def test_recall_of_edited_items(sf, documents):
    own = benchmark(sf)
    items = D.Items([i for i, _ in own], [t for _, t in own])
    found = total = 0
    for seed in range(5):
        cases = list(planted(documents, own, seed, D.MAX_EDITS))
        for (i, _), got in zip(cases, items.find([t for _, t in cases])):
            total += 1
            found += i in {items.ids[n] for n in got}
    assert found >= 0.95 * total


def vocabulary(r, n=3000):
    """Words as often as in prose."""
    weights = [1 / (k + 3) for k in range(n)]
    return lambda m: r.choices(range(1, n + 1), weights, k=m)


@pytest.mark.parametrize("size", [20, 60, 200, 600, 2000])
def test_recall_at_all_sizes(size):
    r = random.Random(size)
    words, n = vocabulary(r), 120 if size < 600 else 40
    texts = [" ".join(f"w{w}" for w in words(size)) for _ in range(n)]
    items = D.Items(list(range(n)), texts)
    cases = []
    for t in texts:
        own = t.split()
        for _ in range(int(D.MAX_EDITS * size)):
            at, what = r.randrange(len(own)), r.randrange(3)
            own[at:at + (what != 1)] = [] if what == 2 else [f"x{r.randrange(500)}"]
        cases.append(" ".join([f"w{w}" for w in words(200)] + own + [f"w{w}" for w in words(200)]))
    found = sum(i in {items.ids[k] for k in got} for i, got in enumerate(items.find(cases)))
    assert found >= 0.95 * n


@pytest.mark.parametrize("size", [5, 8, 20, 60, 400, 2000])
def test_unrelated_windows_share_no_key(size):
    words = vocabulary(random.Random(size))
    rows = mixed(np.array([words(size) for _ in range(60)], dtype=np.uint64))
    keys = D.embedded_keys(rows, np.full(60, size, dtype=np.int64), D.repetitions(size))
    shared = [bool((keys[:, i] == keys[:, j]).any()) for i in range(60) for j in range(i)]
    assert sum(shared) <= 0.05 * len(shared)


def test_query_equals_brute_force(spark, sf, documents):
    from fundlens.llm.queries import queries

    got = {(r.doc_id, r.item_id): r.edits for r in queries()["op3_benchmark_leaks"](spark, sf).collect()}
    own = benchmark(sf)
    words, begins = D._words([t for _, t in own])
    docs, at = D._words([t for _, t in documents])
    want = {}
    for n, (i, _) in enumerate(own):
        item = words[begins[n]:begins[n + 1]].tolist()
        for d, (doc, _) in enumerate(documents):
            text = docs[at[d]:at[d + 1]].tolist()
            if len(set(item) & set(text)) < len(set(item)) - int(D.MAX_EDITS * len(item)):
                continue  # each edit takes one word of the item at most
            if (edits := brute.stretch_distance(item, text)) <= int(D.MAX_EDITS * len(item)):
                want[doc, i] = edits
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want) and want
    assert all(want[k] <= v for k, v in got.items())


def test_blocks_give_the_same(spark, sf):
    from fundlens.llm.queries import table

    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    one, many = D.find_items(docs, items), D.find_items(docs, items, block_bytes=2000)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    left = D.without_items(docs, items, block_bytes=2000).count()
    assert left == docs.count() - one.select("doc_id").distinct().count()


def test_cases(spark, edges, empty):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two"), (4, "one two three four five six"), (5, "a b a b a b a b a b"),
         (6, "one two three four five six")], "item_id int, text string")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in D.find_items(edges, items).collect())
    assert got == [(6, 3, 0), (6, 4, 0), (6, 6, 0), (7, 3, 0), (7, 3, 0), (7, 4, 0), (7, 4, 0), (7, 6, 0), (7, 6, 0), (10, 5, 0)]
    assert D.find_items(empty, items).count() == 0 and D.find_items(edges, items.limit(0)).count() == 0
    assert D.without_items(edges, items.limit(0)).count() == edges.count()


def test_short_and_unspaced_items(spark, tmp_path):
    from fundlens.llm.queries import queries

    items = [(1, "two Three"), (2, "one"), (3, "two, three"), (4, "四 五"), (5, "今天天气很好，我们去公园散步吧。"), (6, "..."), (7, None),
             (8, "a b c d")]
    docs = [(1, "One two three"), (2, "two"), (3, "two four three"), (4, "x四五六y"), (5, "他说今天天气很好我们去公园散步吧然后走了"),
            (6, "今天天气很糟，我们去公园散步吧"), (7, None), (8, "a b c"), (9, "d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, queries()["op3_benchmark_leaks"](spark, str(tmp_path)).collect()))
    assert [r[:3] for r in got] == [(1, 1, 0), (1, 2, 0), (1, 3, 0), (4, 4, 0), (5, 5, 0), (6, 5, 1)]
    assert [r[3] for r in got[:4]] == [1, 0, 1, 1]
    benchmark = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    left = D.without_items(spark.read.parquet(f"{tmp_path}/documents.parquet"), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 7, 8, 9]
