import math
import zlib

import numpy as np
import pandas as pd

from fundlens.llm import toxicity


def test_query_on_held_out_rows(spark):
    import duckdb

    from fundlens.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = queries()["op6_toxicity"](spark, sf).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(p and t for p, t in held) / sum(t for _, t in held)
    # Some toxic labels of this table are on texts without any abuse.
    assert caught > 0.7 and not any(p and not t for p, t in held)


def test_label_model_finds_a_missed_label():
    votes = np.zeros((300, 4))
    votes[:60] = np.random.default_rng(1).random((60, 4)) < 0.7
    votes[:60, 0] = 1
    labels = np.r_[np.ones(60), np.zeros(240)]
    labels[5] = 0
    p = toxicity.label_model(votes, labels)
    assert p[:60].min() > 0.9 and p[60:].max() < 0.1


def test_word_beginnings():
    v = toxicity.Voters(["vequ*", "scum"])
    assert v.hits("Un véqu vequaire, scummy SCUM")[0] == 1 and v.hits("scummy").get(1) is None
    assert v.hits("SCUM")[1] == 1 and v.hits(None) == {} == v.hits("")


def test_cases(spark, edges, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(30)] + [(4, 0, None)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(edges, labels).collect()
    assert len(got) == edges.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(empty, labels).count() == 0
    none = toxicity.score_documents(edges, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    clean = toxicity.score_documents(edges, labels.filter("toxic = 0")).collect()
    assert {r.predicted for r in clean} == {0}


def plain_hits(entries, text):
    """How often each voter fires, place by place."""
    text, spots, hits = (text or "").lower(), set(), [0] * (len(entries) + 3)
    uses = [(n, e.rstrip("*"), not e.endswith("*")) for n, e in enumerate(entries)]
    for n, word, whole in uses + [(len(entries), w, True) for w in toxicity.LEXICON]:
        at = text.find(word)
        while at >= 0:
            end = at + len(word)
            if not text[max(0, at - 1):at].isalpha() and not (whole and text[end:end + 1].isalpha()):
                hits[n] += 1
                spots.add(at)
            at = text.find(word, at + 1)
    hits[-2] = len(spots) if len(spots) > 1 else 0
    hits[-1] = sum(1 for s in spots if toxicity._AIMED.search(text[max(0, s - 60):s]))
    return hits


def plain_posterior(votes, labels):
    """Expectation maximisation in loops, with correlations estimated anew in each round."""
    votes = [[float(v > 0) for v in row] + [float(not any(row))] for row in votes]
    n, m = len(votes), len(votes[0])
    post = [min(max(y, 0.02), 0.98) for y in labels]

    def rate(weights, values):
        return (sum(w * v for w, v in zip(weights, values, strict=True)) + 0.5) / (sum(weights) + 1)

    for _ in range(30):
        other = [1 - p for p in post]
        columns = list(zip(*votes, strict=True))
        on, off = [rate(post, c) for c in columns], [rate(other, c) for c in columns]
        rest = [[c[i] - post[i] * on[k] - other[i] * off[k] for i in range(n)] for k, c in enumerate(columns)]
        spread = [(sum(x * x for x in r) / n) ** 0.5 + 1e-9 for r in rest]
        weight = []
        for a in range(m):
            shared = [abs(sum(x * y for x, y in zip(rest[a], rest[b], strict=True)) / n / (spread[a] * spread[b])) for b in range(m) if b != a]
            weight.append(math.log(on[a] / off[a]) / (1 + sum(c for c in shared if c >= 0.2)))
        right, wrong, prior = rate(post, labels), rate(other, labels), min(max(sum(post) / n, 1e-4), 1 - 1e-4)
        new = []
        for row, y in zip(votes, labels, strict=True):
            logit = math.log(prior / (1 - prior)) + sum(v * w for v, w in zip(row, weight, strict=True))
            logit += math.log(right / wrong) if y else math.log((1 - right) / (1 - wrong))
            new.append(1 / (1 + math.exp(-min(max(logit, -30), 30))))
        moved, post = max(abs(a - b) for a, b in zip(new, post, strict=True)), new
        if moved < 1e-6:
            break
    return post


def test_equals_a_plain_version(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    toxic = dict(duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{sf}/labels.parquet' WHERE toxic IS NOT NULL GROUP BY ALL").fetchall())
    families, docs = set(), []
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall():
        family = toxicity._family(pd.Series([text]))[0]
        if family not in families:  # one of each family, so that it doesn't matter which one teaches
            families.add(family)
            docs.append((i, text))
    rows = [(text or "", toxic[i]) for i, text in docs if i in toxic and zlib.crc32(str(i).encode()) % 3 != 1]
    counts = {}
    for text, y in rows:
        for e in toxicity.candidates(text):
            counts.setdefault(e, [0, 0])[1 - y] += 1
    counts = {e: c for e, c in counts.items() if c[0] >= 2}
    positive = sum(y for _, y in rows)
    support = max(toxicity.least_support(len(counts), positive / len(rows)), math.ceil(toxicity.MIN_SHARE * positive))
    entries = toxicity.choose([(e, t, c) for e, (t, c) in counts.items() if t >= support and t >= toxicity.MIN_PRECISION * (t + c)])

    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    model = toxicity.fit(frame, labels)
    assert model.voters.entries == entries and len(entries) > 3

    def features(text):
        hits = plain_hits(entries, text)
        fired = sum(hits[:len(entries) + 1])
        return [float(h > 0) for h in hits] + [math.log1p(fired), float(fired > 0), 1.0]

    def probability(x):
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights, strict=True))))

    posterior = plain_posterior([plain_hits(entries, t) for t, _ in rows], [y for _, y in rows])
    x = [features(t) for t, _ in rows]
    # The weights are those at which the penalised likelihood of the posterior labels is level.
    for k, w in enumerate(model.weights):
        slope = sum(f[k] * (p - probability(f)) for f, p in zip(x, posterior, strict=True))
        assert abs(slope - (0.1 if k + 1 < len(model.weights) else 1e-6) * w) < 1e-4
    got = {r.doc_id: r for r in toxicity.score_documents(frame, labels).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        assert abs(got[i].score - probability(features(text))) < 1e-9
        assert got[i].predicted == (got[i].score >= 0.7)
