import random

import numpy as np
import pytest

from . import brute
from fundlens.llm import jaccard, signature_trees
from fundlens.llm.components import connected


def rows(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_query_equals_brute_force(spark, sf, documents):
    from fundlens.llm.queries import queries

    want = sorted((i, *v) for i, v in brute.components(documents).items())
    assert rows(queries()["op5_jaccard_join"](spark, sf)) == want


@pytest.mark.parametrize("limits", [(4096, 2000), (3, 2)])
def test_families_of_near_copies(spark, monkeypatch, limits):
    monkeypatch.setattr(jaccard, "MAX_GROUP", limits[0])
    monkeypatch.setattr(jaccard, "MAX_STAR", limits[1])
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    passage, docs = [word() for _ in range(60)], []
    for family in range(6):
        base = passage + [word() for _ in range(r.randint(10, 200))]
        for _ in range(12):
            own = list(base)
            for _ in range(r.randint(0, max(1, len(own) // 40))):
                own[r.randrange(len(own))] = word()
            docs.append((len(docs), " ".join(own[:r.randint(int(0.85 * len(own)), len(own))])))
    got = rows(jaccard.join_documents(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == sorted((i, *v) for i, v in brute.components(docs).items())


def test_trees_drop_no_similar_pair():
    r = np.random.default_rng(4)
    base = [r.integers(0, 1 << 62, n) for n in (5, 40, 40, 300, 2000)]
    sets = []
    for _ in range(120):
        b = base[r.integers(len(base))]
        keep = b[r.random(len(b)) < r.uniform(0.7, 1)]
        sets.append(np.unique(np.append(keep, r.integers(0, 1 << 62, 1 + len(b) // 20)).astype(np.uint64)))
    level = signature_trees.items(np.array([jaccard.bitmap(s) for s in sets]).view(np.uint64),
                                  np.array([len(s) for s in sets]), np.arange(len(sets)))
    got = {(i, j) for x, y in signature_trees.join(level, 75) for i, j in zip(x.tolist(), y.tolist())}
    halves = {(i, j) for x, y in signature_trees.join(level, 75, 50) for i, j in zip(x.tolist(), y.tolist())}
    similar = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            c = len(np.intersect1d(sets[i], sets[j]))
            if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                similar.add((i, j))
    assert similar and similar <= got and len(got) < 120 * 119 / 2
    assert {(i, j) for i, j in similar if i < 50 <= j} <= halves


def test_components(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, 102), (102, 101), (7, 7), (3, 2)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_cases(edges, empty):
    got = rows(jaccard.join_documents(edges))
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    want = brute.components(docs)
    assert got == sorted((i, *want[i]) for i, _ in docs)
    assert rows(jaccard.join_documents(empty)) == []


def link_counts(docs):
    """By definition: of each text the other sets that its own links with."""
    sets = {i: brute.shingles(t) for i, t in docs}
    every = set(sets.values()) - {frozenset()}
    return {i: sum(s != x and 100 * len(s & x) >= 75 * len(s | x) for x in every) if s else 0 for i, s in sets.items()}


@pytest.mark.parametrize("limits", [(4096, 1 << 21, 1024, 1024, 48), (3, 100, 7, 2, 2), (8, 1 << 21, 50, 3, 0)])
def test_links_within_components_are_counted(spark, edges, empty, monkeypatch, limits):
    for name, value in zip(("MAX_BLOCK", "MAX_TOKENS", "COLUMNS", "STRIP", "FEW"), limits):
        monkeypatch.setattr(jaccard, name, value)
    r, docs = random.Random(6), []
    for family in range(3):
        base = [f"{family}w{n}" for n in range(120)]
        for _ in range(14):  # a chain and its shortcuts, copies included
            docs.append((len(docs), " ".join(base[r.randrange(30):120 - r.randrange(30)])))
    docs += [(len(docs), docs[3][1]), (len(docs) + 1, docs[3][1].upper()), (3, docs[3][1])]
    want = link_counts(docs)
    assert max(want.values()) > 2 and 0 < sum(want.values()) < 14 * 13 * 3
    got = jaccard.join_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_links) for x in got) == sorted((i, want[i]) for i, _ in docs)
    cases = [(x.doc_id, x.text) for x in edges.collect()]
    want = link_counts(cases)
    assert sorted((x.doc_id, x.n_links) for x in jaccard.join_documents(edges).collect()) == sorted(
        (i, want[i]) for i, _ in cases)
    assert jaccard.join_documents(empty).columns[-1] == "n_links" and jaccard.join_documents(empty).count() == 0


@pytest.mark.parametrize("few", [0, 3, 48])
@pytest.mark.parametrize("split", [None, 20])
def test_common_shingles_are_counted_by_what_sets_lack(monkeypatch, few, split):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "STRIP", 7)
    r = np.random.default_rng(few)
    base = r.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.append(base[r.random(60) < r.uniform(0.6, 1)], r.integers(0, 40, 1 + k % 9).astype(np.uint64))) for k in range(50)]
    found = jaccard.similar(sets, split)
    rows, columns = (sets, sets) if split is None else (sets[:split], sets[split:])
    for i, x in enumerate(rows):
        for j, y in enumerate(columns):
            c = len(np.intersect1d(x, y))
            assert found[i, j] == (100 * c >= 75 * (len(x) + len(y) - c) and (split is not None or i != j))


def test_null_ids(spark):
    base = "some words that make a text of its own with quite a few shingles in it so that one more changes little"
    docs = [(1, base), (None, base), (2, base + " more"), (4, base + " more words"), (None, "no other text is like this one here"),
            (None, "no other text is like this one here"), (None, None), (9, ""), (None, base + " else")]
    got = jaccard.join_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    assert {(r.doc_id, r.component_id, r.n_links) for r in got} == {
        (1, 1, 3), (None, 1, 3), (2, 1, 3), (4, 1, 3), (None, None, 0), (9, 9, 0)}
    assert sorted(r.n_shingles for r in got if r.component_id is None) == [0, 4, 4]
    few = jaccard.join_documents(spark.createDataFrame(docs, "doc_id string, text string"), counted=False)
    assert {(r.doc_id, r.component_id) for r in few.collect()} == {
        ("1", "1"), (None, "1"), ("2", "1"), ("4", "1"), (None, None), ("9", "9")}
