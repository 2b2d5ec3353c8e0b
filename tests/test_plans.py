"""Physical-plan assertions: the plans we want at scale, not just right rows."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL

from fundlens.plans import registry
from fundlens.sources.campaigns import campaigns

Q = registry.queries()


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_region_enrich_broadcasts_checked_lookup(spark):
    p = plan(Q["region_enrich"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_partition_pruning_reaches_scan(spark):
    p = plan(Q["partition_pruned_count"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(country" in p and "NATION_1" in p


def test_parquet_scan_prunes_columns(spark):
    p = plan(Q["parquet_scan"](spark, SF_SMALL))
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert scan and all("blurb" not in s for s in scan)


def test_view_plans_only_needed_joins(spark):
    p = plan(campaigns(spark, SF_SMALL, ["id", "goal"], live=True))
    assert "lineitem" not in p and "documents" not in p and "customer" not in p
    p = plan(campaigns(spark, SF_SMALL, ["id", "category", "state"], live=True))
    assert "lineitem" in p and "documents" not in p and "nation" not in p


def test_lineitem_aggregated_before_join(spark):
    p = plan(campaigns(spark, SF_SMALL, ["id", "pledged"], live=True))
    head = p.split("\n\n")[0]
    # partial aggregate sits directly above the lineitem scan, below the join
    assert head.index("HashAggregate") > head.index("Join")


@pytest.mark.parametrize("key", ["kpi_dashboard", "success_by_category", "dq_checks", "histogram_merge",
                                 "goal_tier_summary", "top10_funded", "hash_split", "score_linear"])
def test_no_python_in_hot_path(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
        assert bad not in p


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(Q["top10_funded"](spark, SF_SMALL))


def test_filters_pushed_to_scan(spark):
    from fundlens.operators import clean as K
    from fundlens.sources.campaigns import load_table

    df = load_table(spark, SF_SMALL, "orders", ["o_orderkey", "o_totalprice"])
    p = plan(K.exclude_members(df.withColumnRenamed("o_orderkey", "id"), "id", [1, 2]))
    assert "PushedFilters" in p and "o_orderkey" in p


def test_materialized_table_prunes_columns(spark):
    p = plan(campaigns(spark, SF_SMALL, ["id", "category", "state"]))
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert scan == ["ReadSchema: struct<id:bigint,category:string,state:int>"]
    assert "Exchange" not in p


def test_validation_rules_pushed_to_scan(spark):
    p = plan(Q["validate"](spark, SF_SMALL))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")]
    assert pushed and "GreaterThan(goal,0.0)" in pushed[0] and "In(state" in pushed[0]


@pytest.mark.parametrize("key", ["row_count", "partition_inventory", "partition_files"])
def test_counts_read_footers_only(spark, key):
    p = plan(Q[key](spark, SF_SMALL))
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert scan and all(s == "ReadSchema: struct<>" for s in scan)


def test_running_sums_have_no_window_over_all_ranges(spark):
    """Ranges are summed within coarse ranges; only the totals of these pass one window."""
    from fundlens.operators import ordered

    df = spark.range(1000).selectExpr("id / 1000.0 AS k", "id AS v")
    p = plan(ordered.running_sums(df, "k", ["v"]))
    specs = re.findall(r"windowspecdefinition\((.*?) ASC", p)
    assert any("_r#" in w for w in specs)
    for spec in specs:  # partitioned by what comes before the order
        by, order = spec.rpartition(", ")[::2]
        assert not order.startswith("_r#") or "_c#" in by


def test_one_coarse_range_of_many_holds_few_ranges(spark):
    from pyspark.sql import functions as F

    from fundlens.operators import ordered

    half = 2 * ordered._STEPS * ordered.FINENESS
    assert (4 * half) >> ordered.COARSE < 5000 and 1 << ordered.COARSE < 5000
    df = spark.range(5000).selectExpr("CAST(id AS double) / 7 - 300 AS k", "id % 13 AS v", "id % 2 AS g")
    for descending in (False, True):
        got = ordered.running_sums(df, "k", ["v"], descending, group_cols=["g"])
        rows = {(r["g"], r["k"]): (r["cum_v"], r["tot_v"]) for r in got.collect()}
        for g in (0, 1):
            total, own = 0, sorted(((r["k"], r["v"]) for r in df.filter(F.col("g") == g).collect()), reverse=descending)
            every = sum(v for _, v in own)
            for k, v in own:
                total += v
                assert rows[g, k] == (total, every)


def _own_tables(folder, spark, repeated=False):
    """Orders with repeated, missing and unmatched keys, and if wanted repeated keys of customers and documents."""
    import datetime as dt

    day = dt.datetime(2020, 1, 2, 3, 4, 5, 600000)
    rows = {
        "orders": ([(1, 10, 50.0, day, "1-URGENT"), (1, 11, 5.0, day, "2-HIGH"), (2, None, 7.5, None, None), (None, 10, 9.0, day, "5-LOW"), (3, 99, 1.0, day, "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 20.25, day), (1, 30.0, day + dt.timedelta(days=3)), (2, None, None), (4, 1.0, day)],
                     "l_orderkey long, l_extendedprice double, l_shipdate timestamp"),
        "customer": ([(10, "a", 0, "X"), (10, "b", 1, "Y"), (11, None, None, None)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, "N0"), (1, "N1")], "n_nationkey int, n_name string"),
        "documents": ([(1, "text"), (1, ""), (3, None)], "doc_id long, text string"),
    }
    for name, (data, schema) in rows.items():
        if name in ("customer", "documents") and not repeated:
            data = [data[0], data[2]]
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("repeated", [True, False])
def test_narrow_tables_are_widened_to_the_same_rows(spark, tmp_path, repeated):
    """However its parts were written, the view has the rows of the whole live plan, and no query writes parts it doesn't need."""
    from fundlens.sources.campaigns import CAMPAIGN_COLUMNS, _key, _materialized

    sf = _own_tables(tmp_path, spark, repeated)
    rows = lambda df: sorted(map(str, df.collect()))
    whole = campaigns(spark, sf, live=True)
    asked = [["id", "blurb"], ["id", "backers_count", "launched_at"], ["id", "category", "country", "state"], ["id", "name", "deadline"], CAMPAIGN_COLUMNS,
             ["creator", "blurb", "state"], ["country"]]
    for cols in asked:
        assert rows(campaigns(spark, sf, cols)) == rows(whole.select(*cols)), cols
    held = _materialized[_key(spark, sf)]
    every = ["lines", "place", "names", "blurb"]
    assert set(held) == {frozenset(p) for p in ([every] if repeated else [["lines"], ["lines", "place"], ["lines", "names"], every])}
    if not repeated:
        assert not {"blurb", "name", "category"} & set(spark.read.parquet(held[frozenset(["lines"])]).columns)


def test_missing_blurbs_wait_for_no_line_items(spark, tmp_path):
    sf = _own_tables(tmp_path, spark)
    p = plan(Q["kpi_missing_blurb"](spark, sf))
    assert "documents" in p and "lineitem" not in p and "fundlens/campaigns-" not in p


def test_salts_shuffle_no_rows(spark, monkeypatch):
    """The numbers of files of a small store's keys are broadcast, so that its rows are shuffled once, to where they are written."""
    from pyspark.sql import functions as F

    from fundlens.operators import enrich
    from fundlens.session import scratch_path
    from fundlens.sources import files as IO

    seen = []
    old = enrich.sized_broadcast
    monkeypatch.setattr(enrich, "sized_broadcast", lambda df, *a: (seen.append(old(df, *a)), seen[-1])[1])
    df = spark.range(100).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("country"))
    path = IO.write_partitioned(df, scratch_path(spark, "salted"))
    assert spark.read.parquet(path).count() == 100
    (salts,) = seen
    assert "ResolvedHint (strategy=broadcast)" in salts._jdf.queryExecution().analyzed().toString()
    assert "FileScan" in salts._jdf.queryExecution().toString()  # counted once
