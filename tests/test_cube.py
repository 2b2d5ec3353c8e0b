"""Measures from the cube's cells equal those from the rows; its states merge."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundlens.operators import cube as CU
from fundlens.operators import dashboard as D
from fundlens.sources.campaigns import campaigns


@pytest.fixture(scope="module")
def rows(spark):
    df = campaigns(spark, SF_SMALL)
    odd = df.limit(40).withColumns({"category": F.lit(None).cast("string"), "goal": F.when(F.col("id") % 3 > 0, F.col("goal")),
                                    "blurb": F.when(F.col("id") % 2 > 0, ""), "created_at": F.lit(None).cast("long"),
                                    "backers_count": F.when(F.col("id") % 5 > 0, F.col("backers_count")),
                                    "state": F.when(F.col("id") % 7 > 0, F.col("state"))})
    return df.unionByName(odd)


@pytest.fixture(scope="module")
def cells(rows):
    return CU.summary_cube(rows)


def same(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_measures_equal_the_direct_ones(rows, cells):
    same(CU.by_outcome(cells), D.backers_vs_pledged_by_outcome(rows))
    same(CU.by_month(cells), D.volume_by_month(rows))
    own = CU.by_category(cells)
    same(own.select("category", "n_campaigns", "success_rate"), D.success_by_category(rows))
    same(own.select("category", "avg_backers", "avg_pledged"), D.efficiency_by_category(rows))
    same(own.select("category", "scalability_index"), D.scalability_by_category(rows))
    tiles = [c for c in D.KPI_MEASURES if c != "avg_funding"]
    same(CU.kpis(cells).select(tiles), D.kpi(rows, *tiles))


def test_cubes_of_parts_merge_to_the_whole(rows, cells):
    parts = [CU.summary_cube(rows.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == k)) for k in range(3)]
    stacked = CU.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), CU.DIMENSIONS)
    exact = [c for c in cells.columns if c != "names"]
    same(stacked.select(exact), cells.select(exact))
    same(CU.kpis(stacked), CU.kpis(cells))


def test_sketches_of_any_subset(rows, cells):
    """The union of cells' sketches is the sketch of their rows, and near the exact count."""
    for condition in ("true", "country = 'NATION_1'", "category IS NOT NULL AND state = 1"):
        union = cells.filter(condition).agg(F.hll_sketch_estimate(F.hll_union_agg("names")).alias("e")).first()["e"]
        direct = rows.filter(condition).agg(F.hll_sketch_estimate(F.hll_sketch_agg("name", CU.SKETCH_BITS)).alias("e"),
                                            F.count_distinct("name").alias("n")).first()
        assert abs(union - direct["e"]) <= max(1, 0.01 * direct["n"])
        assert abs(union - direct["n"]) <= max(1, 4 * 1.04 / 2 ** (CU.SKETCH_BITS / 2) * direct["n"])


def test_no_rows(spark, rows):
    none = CU.summary_cube(rows.limit(0))
    assert none.count() == 0 and CU.by_category(none).count() == 0
