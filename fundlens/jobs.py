"""Batch pipeline jobs over real campaign exports, composed of fundlens operators.

    python -m fundlens.jobs ingest   --csv exports/*.csv --out store/
    python -m fundlens.jobs train    --store store/ --models models/
    python -m fundlens.jobs evaluate --store store/ --models models/ --report report/

``ingest``: CSV -> validate -> region enrich -> country-partitioned Parquet.
``train``: store -> features -> hash split -> LR, RF, DT and GBT with CV ->
whole pipelines saved under ``--models`` plus a metrics table.
``evaluate``: reload the pipelines, score the test split, write metric,
ROC and PR tables as JSON. Every step runs on the cluster; only one-row
metric results and parameter tables reach the driver.
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import clean as K
from .operators import enrich as E
from .operators import evaluation as EV
from .operators import models as M
from .operators import sampling as SM
from .sources import files as IO
from .sources.schema import RAW_CSV_SCHEMA, REQUIRED_COLUMNS

MODEL_NAMES = ("LR", "RF", "DT", "GBT")


def ingest(spark: SparkSession, csv_path: str, out_path: str, lookup: DataFrame | None = None,
           infer: bool = False, multiline: bool = True) -> DataFrame:
    """Returns the validation report, with the number of rows that don't fit the schema; writes
    the partitioned store. The export is parsed once: report, count of rows and store read the parsed rows."""
    raw = IO.read_campaigns_csv(spark, csv_path, schema=None if infer else RAW_CSV_SCHEMA, infer=infer,
                                multiline=multiline, required=REQUIRED_COLUMNS, keep_corrupt=not infer)
    raw = raw.withColumn("duration", F.col("deadline") - F.col("launched_at")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        corrupt = F.count(IO.CORRUPT) if IO.CORRUPT in raw.columns else F.lit(0).cast("long")
        report = K.validation_report(raw, extra=[corrupt.alias("rows_corrupt")])
        report = spark.createDataFrame(report.collect(), report.schema)  # one row
        good = K.validate(raw).drop(IO.CORRUPT)
        IO.write_partitioned(E.region_enrich(good, lookup if lookup is not None else E.iso_region_lookup(spark)), out_path)
    finally:
        raw.unpersist()
    return report


def _split(spark: SparkSession, store: str, seed: int = 42, folds: int = 2) -> DataFrame:
    df = M.prepare(spark.read.parquet(store))
    return SM.kfold(SM.with_split(df, "id", 0.8, seed), folds, "id", seed)


def train(spark: SparkSession, store: str, models_dir: str, names=MODEL_NAMES, seed: int = 42) -> DataFrame:
    """Fit the models on the train split, save each whole pipeline, return metrics."""
    data = _split(spark, store, seed).persist(StorageLevel.MEMORY_AND_DISK)
    train_df, test_df = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    fitters = {"LR": M.fit_lr, "RF": M.fit_rf, "DT": M.fit_dt,
               "GBT": lambda d: M.fit_gbt_cv(d, num_folds=2)}
    out = None
    try:
        for name in names:
            model, secs = fitters[name](train_df)
            M.save_model(model.bestModel if name == "GBT" else model, f"{models_dir.rstrip('/')}/{name}")
            row = EV.metric_row(M.score_model(model, test_df), name, extra={"train_seconds": float(secs)})
            row = spark.createDataFrame(row.collect(), row.schema)  # one row, detached from the cache
            out = row if out is None else out.unionByName(row)
    finally:
        data.unpersist()
    return out


def evaluate(spark: SparkSession, store: str, models_dir: str, report_dir: str, names=MODEL_NAMES,
             seed: int = 42) -> DataFrame:
    """Score the test rows once per model; metrics, ROC and PR tables read the scores."""
    test_df = _split(spark, store, seed).filter(F.col("split") == "test").persist(StorageLevel.MEMORY_AND_DISK)
    scored = None
    for name in names:
        one = M.score_model(M.load_pipeline(f"{models_dir.rstrip('/')}/{name}"), test_df)
        one = one.select(F.lit(name).alias("model"), "label", "prediction", "score")
        scored = one if scored is None else scored.unionByName(one)
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name in names:
            own = scored.filter(F.col("model") == name)
            IO.write_json(EV.roc_points(own), f"{report_dir.rstrip('/')}/roc/{name}")
            IO.write_json(EV.pr_points(own), f"{report_dir.rstrip('/')}/pr/{name}")
        IO.write_json(EV.metric_rows(scored).coalesce(1), f"{report_dir.rstrip('/')}/metrics")
    finally:
        scored.unpersist()
        test_df.unpersist()
    return spark.read.json(f"{report_dir.rstrip('/')}/metrics")


def main(argv=None):
    from .session import get_session, scale_conf

    ap = argparse.ArgumentParser(prog="fundlens.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--csv", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--infer", action="store_true")
    a.add_argument("--single-line", action="store_true", help="no embedded newlines: large files are split")
    for p in (a,):
        p.add_argument("--input-gb", type=float, default=0, help="size of the export; sets partition sizes")
        p.add_argument("--executors", type=int, default=1)
    t = sub.add_parser("train")
    t.add_argument("--store", required=True)
    t.add_argument("--models", required=True)
    e = sub.add_parser("evaluate")
    e.add_argument("--store", required=True)
    e.add_argument("--models", required=True)
    e.add_argument("--report", required=True)
    args = ap.parse_args(argv)
    sized = scale_conf(int(args.input_gb * (1 << 30)), args.executors) if getattr(args, "input_gb", 0) else None
    spark = get_session(extra=sized)
    if args.cmd == "ingest":
        ingest(spark, args.csv, args.out, infer=args.infer, multiline=not args.single_line).show()
    elif args.cmd == "train":
        train(spark, args.store, args.models).show()
    else:
        evaluate(spark, args.store, args.models, args.report).show()


if __name__ == "__main__":
    main()
