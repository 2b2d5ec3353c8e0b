"""Hand-written edge tables (FIXTURES.md §6)."""

import math

from pyspark.sql import functions as F


from fundlens.functions import columns as C
from fundlens.operators import clean as K
from fundlens.operators import dashboard as D
from fundlens.operators import enrich as E
from fundlens.operators import evaluation as EV
from fundlens.operators import profile as P
from fundlens.session import scratch_path
from fundlens.sources import files as IO
from fundlens.sources.schema import CAMPAIGN_SCHEMA

DAY = 86400


def test_csv_edges_round_trip(spark):
    rows = [
        (1, "multi\nline blurb", "a", "b, with comma"),
        (2, 'say "hi"', "c", "d"),
        (3, None, "e", ""),
        (4, "", None, "x"),
    ]
    df = spark.createDataFrame(rows, "id long, blurb string, category string, name string")
    path = IO.write_csv(df, scratch_path(spark, "csv-edges"))
    back = IO.read_campaigns_csv(spark, path, schema=df.schema)
    got = {r["id"]: r for r in back.collect()}
    assert got[1]["blurb"] == "multi\nline blurb"
    assert got[1]["name"] == "b, with comma"
    assert got[2]["blurb"] == 'say "hi"'
    assert got[3]["blurb"] is None
    assert got[4]["category"] is None


def _rules(spark):
    rows = [
        (1, 0.0, 1, "games", "NATION_0", 0, 10),
        (2, -5.0, 1, "games", "NATION_0", 0, 10),
        (3, None, 0, "games", "NATION_0", 0, 10),
        (4, 100.0, 0, "games", "NATION_0", 0, 10),
        (5, 100.0, 1, "games", "NATION_0", 0, 10),
        (6, 100.0, 2, "games", "NATION_0", 0, 10),
        (7, 100.0, None, "games", "NATION_0", 0, 10),
        (8, 100.0, 1, None, "NATION_0", 0, 10),
        (9, 100.0, 1, "art", "ATLANTIS", 0, None),
        (10, 100.0, 0, "art", "ATLANTIS", 0, 10),
    ]
    return spark.createDataFrame(rows, "id long, goal double, state int, category string, country string, "
                                       "launched_at long, deadline long")


def test_validate_rules(spark):
    got = sorted(r["id"] for r in K.validate(_rules(spark)).collect())
    assert got == [4, 5, 10]
    rep = K.validation_report(_rules(spark)).first()
    assert (rep["rows_before"], rep["rows_after"], rep["rows_dropped"]) == (10, 3, 7)


def test_validate_malformed_strings(spark):
    df = spark.createDataFrame([(1, "abc", "1", "x", "y", 0, 1), (2, "10", "1", "x", "y", 0, 1)],
                               "id long, goal string, state string, category string, country string, "
                               "launched_at long, deadline long")
    assert [r["id"] for r in K.validate(df).collect()] == [2]


def test_dq_checks(spark):
    out = {r["check"]: (r["violations"], r["passed"]) for r in K.dq_checks(_rules(spark)).collect()}
    assert out["not_empty"] == (0, True)
    assert out["goal_non_positive"] == (2, False)
    assert out["state_not_binary"] == (1, False)
    assert out["null_category"] == (1, False)
    assert out["null_goal"] == (1, False)
    assert out["null_state"] == (1, False)
    assert out["null_duration_or_goal_log"][0] == 3  # NULL goal, NULL deadline, log1p(-5) = NULL


def test_dq_checks_missing_columns(spark):
    df = spark.createDataFrame([(1.0,)], "goal double")
    try:
        K.dq_checks(df)
    except ValueError as e:
        assert "missing required columns" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_region_enrich_unmatched_null(spark):
    lookup = spark.createDataFrame([("NATION_0", "AFRICA")], "country string, region string")
    out = {r["id"]: r["region"] for r in E.region_enrich(_rules(spark), lookup).collect()}
    assert out[1] == "AFRICA" and out[9] is None
    miss = E.unmapped_countries(_rules(spark), lookup).collect()
    assert [(r["country"], r["n_campaigns"]) for r in miss] == [("ATLANTIS", 2)]


def test_iso_lookup(spark):
    lk = E.iso_region_lookup(spark)
    assert lk.count() == 25
    assert lk.select("region").distinct().count() == 4


def test_exclude_members(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, creator string")
    assert sorted(r["id"] for r in K.exclude_members(df, "creator", ["a"]).collect()) == [2, 3]
    assert K.exclude_members(df, "creator", []).count() == 3
    # long lists take the anti-join path with identical results, NULLs in the list or not
    assert sorted(r["id"] for r in K.exclude_members(df, "creator", ["a"], max_literal=0).collect()) == [2, 3]
    for limit in (10_000, 1, 0):
        assert sorted(r["id"] for r in K.exclude_members(df, "creator", ["a", None], max_literal=limit).collect()) == [2, 3]
        assert K.exclude_members(df, "creator", [None], max_literal=limit).count() == 3


def test_counts_on_an_empty_table(spark):
    df = spark.createDataFrame([], "category string, country string, goal double, state int, launched_at long, "
                                   "deadline long, staff_pick boolean")
    assert tuple(K.validation_report(df).first()) == (0, 0, 0)
    assert tuple(K.clean_report(K.with_features(df)).first()) == (0, 0, 0)
    assert K.negative_duration(df).first()[0] == 0
    assert set(K.null_profile(df).first()) == {0}
    checks = {r["check"]: (r["violations"], r["passed"]) for r in K.dq_checks(df).collect()}
    assert checks.pop("not_empty") == (1, False) and set(checks.values()) == {(0, True)}
    cells = EV.confusion_matrix(spark.createDataFrame([], "label int, prediction double")).collect()
    assert [r["n"] for r in cells] == [0, 0, 0, 0]


def test_money_sums_do_not_depend_on_order(spark):
    df = spark.range(20_000).select((F.col("id") % 2).cast("int").alias("state"),
                                    (F.col("id") * 37 % 100_003 / 100).alias("pledged"),
                                    F.lit(1).alias("backers_count"), (F.col("id") / 100).alias("goal"))
    got = [sorted(map(tuple, D.backers_vs_pledged_by_outcome(df.repartition(n)).collect())) for n in (3, 7, 31)]
    assert got[0] == got[1] == got[2]


def test_top_blurbs_break_ties_on_whole_texts(spark):
    start = "x" * 100
    rows = [(n, start + chr(122 - n % 20) + str(n), 1.0, "c") for n in range(60)] + [(99, None, 1.0, "c"), (98, "a", None, "c")]
    df = spark.createDataFrame(rows, "id long, blurb string, goal double, category string")
    got = [(r["blurb"], r["completeness"]) for r in D.top_blurb_completeness(df, 5).collect()]
    want = sorted((b for _, b, g, _ in rows if b and g))[:5]
    assert got == [(b, 1.0) for b in want]
    assert D.top_blurb_completeness(df, 100).count() == 62
    assert D.top_blurb_completeness(df.limit(0), 5).count() == 0


def test_time_edges(spark):
    rows = [
        (1, 0, 3600, 5),              # same day
        (2, DAY - 1, DAY + 1, 4),     # crosses midnight: 1 day
        (3, 10 * DAY, 5 * DAY, 10),   # deadline before launch
        (4, None, 5 * DAY, 1),
        (5, 0, 0, 3),                 # zero days: backers_per_day NULL
    ]
    df = spark.createDataFrame(rows, "id long, launched_at long, deadline long, backers_count int")
    out = {r["id"]: r for r in df.select("id", C.duration().alias("d"), C.duration_days().alias("dd"),
                                         C.backers_per_day().alias("bpd")).collect()}
    assert out[1]["dd"] == 0 and out[1]["d"] == 3600
    assert out[2]["dd"] == 1 and out[2]["bpd"] == 4.0
    assert out[3]["dd"] == -5 and out[3]["d"] == -5 * DAY
    assert out[4]["dd"] is None and out[4]["bpd"] is None
    assert out[5]["bpd"] is None


def test_created_month(spark):
    df = spark.createDataFrame([(1, 0), (2, 31 * DAY + 5), (3, -1)], "id long, created_at long")
    got = {r["id"]: str(r["m"]) for r in df.select("id", C.created_month().alias("m")).collect()}
    assert got == {1: "1970-01-01", 2: "1970-02-01", 3: "1969-12-01"}


def test_text_edges_blurb_measures(spark):
    rows = [(1, None, 1.0, "a"), (2, "", 1.0, "a"), (3, "  ", 1.0, "a"), (4, "text", None, None)]
    df = spark.createDataFrame(rows, "id long, blurb string, goal double, category string")
    k = D.kpi(df, "missing_blurb", "completeness", "missing_data").first()
    assert k["missing_blurb"] == 0.5          # NULL and "" count, blank does not
    assert k["completeness"] == round(1 - 3 / 12, 6)  # only NULLs count
    assert k["missing_data"] == 2


def test_goal_tier_edges(spark):
    vals = [999.99, 1000.0, 4999.99, 5000.0, 9999.99, 10000.0, 49999.99, 50000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "goal double")
    got = [r["t"] for r in df.select(C.goal_tier().alias("t")).collect()]
    assert got == ["< $1K", "$1K-$5K", "$1K-$5K", "$5K-$10K", "$5K-$10K", "$10K-$50K", "$10K-$50K",
                   "$50K+", "$50K+"]


def test_overfunded_and_success_flags(spark):
    df = spark.createDataFrame([(200.0, 100.0, 1), (100.0, 100.0, 0), (None, 100.0, None), (5.0, 0.0, 1)],
                               "pledged double, goal double, state int")
    got = [(r["o"], r["s"]) for r in df.select(C.overfunded_flag().alias("o"), C.success_flag().alias("s")).collect()]
    assert got == [("Overfunded", "Successful"), ("Underfunded", "Failed"), ("Underfunded", "Failed"),
                   ("Underfunded", "Successful")]


def test_bucket_edges(spark):
    splits = P.GOAL_SPLITS
    vals = [0.0, splits[1], splits[1] - 1e-6, 5_000_000.0, 9e9, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, goal double")
    got = {r["i"]: r["b"] for r in P.bucketize(df, "goal", "b", splits).collect()}
    assert got[0] == 0 and got[1] == 1 and got[2] == 0
    assert got[3] == 60 and got[4] == 60   # overflow bucket, open to +inf
    assert got[5] == 61                    # NaN kept in its own bucket
    assert got[6] is None


def test_histogram_merge_keys_on_bucket(spark):
    # goal lands in bucket 0 only, goal_log spreads: missing buckets show 0
    df = spark.createDataFrame([(10.0, math.log1p(10.0)), (1000.0, math.log1p(1000.0))], "goal double, goal_log double")
    m = {r["bucket_idx"]: (r["goal_count"], r["goal_log_count"]) for r in P.histogram_merge(df).collect()}
    assert m[0] == (2, 0)
    assert sum(v[1] for v in m.values()) == 2


def test_describe_matches_pandas(spark):
    import pandas as pd

    vals = [1.0, 2.0, 4.0, 8.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["statistic"]: r["x"] for r in P.describe(df, ["x"]).collect()}
    s = pd.Series([1.0, 2.0, 4.0, 8.0])
    assert got["count"] == 4 and got["mean"] == round(s.mean(), 4)
    assert got["stddev"] == round(s.std(), 4) and got["min"] == 1.0 and got["max"] == 8.0


def test_null_profile_dtype_dispatch(spark):
    df = spark.createDataFrame([(float("nan"), None, True, 1), (1.0, "a", None, None)],
                               "goal double, category string, staff_pick boolean, launched_at long")
    r = K.null_profile(df, ["goal", "category", "staff_pick", "launched_at"]).first()
    assert (r["goal"], r["category"], r["staff_pick"], r["launched_at"]) == (1, 1, 1, 1)


def test_campaign_schema_matches_view(spark):
    from conftest import SF_SMALL
    from fundlens.sources.campaigns import campaigns

    df = campaigns(spark, SF_SMALL)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in CAMPAIGN_SCHEMA.fields]
    assert df.count() == df.select("id").distinct().count()


def test_pruned_view_same_rows(spark):
    from conftest import SF_SMALL
    from fundlens.sources.campaigns import campaigns

    full = campaigns(spark, SF_SMALL, live=True).select("id", "goal", "state", "blurb")
    slim = campaigns(spark, SF_SMALL, ["id", "goal"], live=True)
    stored = campaigns(spark, SF_SMALL, ["id", "goal", "state", "blurb"])
    assert sorted(full.select("id", "goal").collect()) == sorted(slim.collect())
    assert sorted(full.collect()) == sorted(stored.collect())


def test_distinct_counts_exact_and_approx(spark):
    df = spark.createDataFrame([(f"c{i % 7}", f"k{i % 3}") for i in range(100)], "country string, category string")
    exact = P.distinct_counts(df).first()
    approx = P.distinct_counts(df, approx=True).first()
    assert (exact["n_country"], exact["n_category"]) == (7, 3)
    assert (approx["n_country"], approx["n_category"]) == (7, 3)  # exact at this size


def test_top_funded_by_pledged(spark):
    rows = [("a", 100, 1.0), ("a", 100, 1.0), ("b", 1, 500.0), ("c", 50, 10.0), (None, 999, 0.0)]
    df = spark.createDataFrame(rows, "name string, backers_count int, pledged double")
    by_backers = [r["name"] for r in D.top_funded(df, 2).collect()]
    by_pledged = [r["name"] for r in D.top_funded(df, 2, by="pledged").collect()]
    assert by_backers == [None, "a"]      # NULL is a member, ranked by AVG(backers)
    assert by_pledged == ["b", "c"]
