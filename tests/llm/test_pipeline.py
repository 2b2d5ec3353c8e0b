import duckdb
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from fundlens.llm import bpe, decontaminate, pii, toxicity
from fundlens.llm.queries import queries, table

from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_brute_force(spark):
    """Each stage's decision by definition: the scores, links by all pairs, items by
    all stretches that may hold them, base spans by plain expressions."""
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    scores = {r.doc_id: r.predicted for r in queries()["op6_toxicity"](spark, sf).collect()}
    left = [(i, t) for i, t in docs if not scores[i]]
    groups = brute.components(left)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    items = duckdb.sql(f"SELECT text FROM '{sf}/benchmark.parquet'").fetchall()
    words, begins = decontaminate._words([t for t, in items])
    own = [words[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]
    all_words, at = decontaminate._words([t for _, t in left])

    def leaks(text):
        return any(len(set(i) & set(text)) >= len(set(i)) - int(decontaminate.MAX_EDITS * len(i))
                   and brute.stretch_distance(i, text) <= int(decontaminate.MAX_EDITS * len(i)) for i in own)

    left = [x for n, x in enumerate(left) if not leaks(all_words[at[n]:at[n + 1]].tolist())]
    codec = bpe.codec(bpe.default_vocabulary(), bpe.default_pattern())
    want = []
    for i, t in left:
        t = pii.redact(t)
        ids = codec.encode(t)
        want.append((i, t, len(t), len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t)))
    got = corpus_pipeline.run(spark, sf)
    assert got.columns[:5] == COLUMNS
    assert sorted(map(tuple, got.select("doc_id", "text", "n_chars", "n_tokens", "ids_sha256",
                                        "decoded_sha256").collect())) == sorted(want)
    assert len(docs) / 2 < len(want) < len(docs)


def test_stages_take_their_predecessors_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == COLUMNS
        after = docs.count()
        assert after <= before
        before = after


def test_cases(spark, sf):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "mail a@b.org", "en", "a", 12),
            (3, "mail a@b.org", "en", "a", 12), (4, "x" * 50_000, "en", "a", 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    got = sorted((r.doc_id, r.text, r.n_tokens) for r in docs.collect() if r.doc_id < 4)
    assert [(i, t) for i, t, _ in got if i > 1] == [(2, ""), (3, "mail [EMAIL]"), (3, "mail [EMAIL]")]
    assert got[0][1:] == (None, 0)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0
    assert toxicity.THRESHOLD == 0.7


def test_workers_let_go_of_the_tokenizer(spark):
    """The stages share their workers: after the last one none of them holds a codec of its sizes."""
    rows = [(n, f"some words, and others that are tokens of number {n}", "en", "a", 9) for n in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    encoded = corpus_pipeline.encode(spark, docs.repartition(16), "").collect()
    codec = bpe.Codec(bpe.default_vocabulary(), bpe.default_pattern())
    assert {r.doc_id: r.n_tokens for r in encoded} == {r[0]: len(codec.encode(r[1])) for r in rows}
    most = corpus_pipeline.MAX_CACHED

    @F.pandas_udf("long")
    def held(ids: pd.Series) -> pd.Series:
        return ids * 0 + sum(key[2] == most for key in bpe._codecs)

    assert spark.range(64).repartition(16).agg(F.max(held("id"))).first()[0] == 0
