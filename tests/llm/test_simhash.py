import random

import numpy as np
import pytest

from . import brute
from fundlens.llm import simhash
from fundlens.llm.queries import queries


def found(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark, sf, documents):
    assert found(queries()["op13_simhash"](spark, sf)) == brute.simhash(documents)


def test_parts_of_long_texts(monkeypatch):
    r = random.Random(3)
    for n in range(30):
        text = "".join(r.choice("ab \n\té") for _ in range(400))
        want = simhash.fingerprint(text)
        assert f"{want:016x}" == brute.simhash([(1, text)])[1][0]
        for size in (1, 3, 7, 64):
            monkeypatch.setattr(simhash, "PART", size)
            assert simhash.fingerprint(text) == want
        monkeypatch.setattr(simhash, "PART", 1 << 20)


def prints(n, seed):
    """Fingerprints at all small distances of some centres, and others."""
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for c in list(out)[:6]:
        for _ in range(n // 4):
            x = c
            for b in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("max_bucket", [3, 50, simhash.MAX_BUCKET])
def test_components_of_fingerprints(spark, max_bucket):
    from fundlens.llm.components import connected

    fps = prints(120, 7)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.id: r.component for r in connected(simhash.links(df, max_bucket)).collect()}
    root = {x: x for x in signed}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(fps):
        for m in range(n + 1, len(fps)):
            if (a ^ fps[m]).bit_count() <= 3:
                x, y = sorted((find(signed[n]), find(signed[m])))
                root[y] = x
    want = {x: find(x) for x in signed}
    assert {x: got.get(x, x) for x in signed} == want and 1 < len(set(want.values())) < len(fps)


def test_every_close_pair_shares_a_bucket(spark):
    r = random.Random(1)
    pairs = []
    for _ in range(3000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(1, 3)):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = np.array(pairs, dtype=np.uint64).view(np.int64).tolist()
    from pyspark.sql import functions as F

    df = spark.createDataFrame(signed, "a long, b long")
    common = F.array_intersect(simhash.bucket_keys(F.col("a")), simhash.bucket_keys(F.col("b")))
    assert df.filter(F.size(common) == 0).count() == 0
    for a, b in pairs[:500]:  # and from one of the shared buckets the chains let it through
        assert any(list(simhash.bucket_links(np.array([a, b], dtype=np.uint64), s)) for s in range(4)
                   if (a ^ b) >> 16 * s & 0xFFFF == 0)


def test_cases(spark, edges, empty):
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(simhash.near_duplicates(edges)) == brute.simhash(docs)
    rows = [(None, "a b c d"), (4, "a b c d"), (None, "alone in the world"), (3, None), (9, "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    own = {(r.doc_id, r.component_id) for r in got}
    assert own == {(None, 4), (4, 4), (None, None), (3, 3), (9, 3)}
    assert simhash.near_duplicates(empty).count() == 0
