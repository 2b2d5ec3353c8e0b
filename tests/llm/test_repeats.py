import pytest

from . import brute
from fundlens.llm import suffixes


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_brute_force(spark, sf, documents):
    from fundlens.llm.queries import queries

    assert rows(queries()["op1_repeated_bytes"](spark, sf)) == sorted(brute.repeated_bytes(documents))


@pytest.mark.parametrize("max_group", [1, suffixes.MAX_GROUP])
def test_cases(edges, max_group):
    got = suffixes.remove_repeats(edges, max_group=max_group)
    assert rows(got) == sorted(brute.repeated_bytes([(r.doc_id, r.text) for r in edges.collect()]))


def test_passages_between_different_texts(spark):
    import random

    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 45, 60, 90)]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(2)]
        p = r.choice(passages)
        cut = r.randint(0, len(p) // 3)
        docs.append((i, parts[0] + p[cut:len(p) - r.randint(0, cut)] + parts[1]))
    for group in (2, suffixes.MAX_GROUP):
        got = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), max_group=group)
        assert rows(got) == sorted(brute.repeated_bytes(docs))


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)  # read on the driver's side of the closure only
    docs = [(1, "abcdefghij" * 100), (2, "".join(chr(97 + n * n % 23) for n in range(900)))]
    got = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got) == sorted(brute.repeated_bytes(docs))


def test_parts_of_a_long_text_cover_its_windows():
    import numpy as np
    import pyarrow as pa

    text = "".join(chr(97 + n * n % 23) for n in range(3000))
    batch = pa.record_batch([pa.array([7]), pa.array([text])], names=["id", "text"])
    old, suffixes.CHUNK = suffixes.CHUNK, 500
    try:
        chunks = list(suffixes._chunks(iter([batch]), 200))
    finally:
        suffixes.CHUNK = old
    windows = np.concatenate([base + np.arange(end - start - 199) for _, _, begins, bases in chunks
                              for start, end, base in zip(begins[:-1], begins[1:], bases)])
    assert sorted(windows.tolist()) == list(range(3000 - 199))


def test_empty(empty):
    assert rows(suffixes.remove_repeats(empty)) == []


@pytest.mark.parametrize("max_group", [1, suffixes.MAX_GROUP])
def test_null_ids(spark, max_group):
    import random

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(1, 9)))
    text, own, part = (" ".join(word() for _ in range(n)) for n in (70, 70, 60))
    docs = [(None, text), (5, text), (None, own + part), (6, part + " tail"), (None, own + " x"), (None, own + " x"), (None, None)]
    got = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), max_group=max_group).collect()
    want = brute.repeated_bytes(docs)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sorted(r.n_removed for r in got)[0] == 0 and sum(r.n_removed > 0 for r in got) == 6
