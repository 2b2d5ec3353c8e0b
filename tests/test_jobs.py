"""The batch jobs on a raw-format export written from the driver tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundlens import jobs
from fundlens.operators import enrich as E
from fundlens.session import scratch_path
from fundlens.sources import files as IO
from fundlens.sources.campaigns import campaigns
from fundlens.sources.schema import RAW_CSV_SCHEMA


def test_ingest_train_evaluate(spark):
    view = campaigns(spark, SF_SMALL)
    raw = view.select(*[F.col(f.name) if f.name in view.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in RAW_CSV_SCHEMA.fields])
    csv = IO.write_csv(raw, scratch_path(spark, "export"))
    store = scratch_path(spark, "job-store")
    lookup = E.region_lookup(spark, SF_SMALL).filter("region <> 'ASIA'")  # a hand-kept mapping may miss keys
    report = jobs.ingest(spark, csv, store, lookup=lookup).first()
    assert report["rows_before"] == view.count() and report["rows_after"] > 0 and report["rows_corrupt"] == 0
    assert spark.read.parquet(store).filter(F.col("region").isNull()).count() > 0  # unmapped kept
    models = scratch_path(spark, "job-models")
    m = jobs.train(spark, store, models, names=("LR", "DT")).collect()
    assert {r["model"] for r in m} == {"LR", "DT"} and all(r["auc"] > 0.5 for r in m)
    ev = {r["model"]: r["auc"] for r in jobs.evaluate(spark, store, models, scratch_path(spark, "job-report"),
                                                       names=("LR", "DT")).collect()}
    assert ev == {r["model"]: r["auc"] for r in m}
