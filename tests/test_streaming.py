"""Streaming ingestion: same rows as the batch validate + enrich path."""

from conftest import SF_SMALL

from fundlens.operators import clean as K
from fundlens.operators import enrich as E
from fundlens.session import scratch_path
from fundlens.sources import files as IO
from fundlens.sources.campaigns import campaigns
from fundlens.streaming import ingest_stream


def test_ingest_stream_matches_batch(spark):
    raw = campaigns(spark, SF_SMALL)
    src = IO.write_csv(raw.repartition(3), scratch_path(spark, "landing"))
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    lookup = E.region_lookup(spark, SF_SMALL)
    q = ingest_stream(spark, src, sink, ckpt, lookup=lookup)
    q.awaitTermination(300)
    got = spark.read.parquet(sink).select("id", "country", "region")
    want = E.region_enrich(K.validate(raw), lookup).select("id", "country", "region")
    assert sorted(got.collect()) == sorted(want.collect())
