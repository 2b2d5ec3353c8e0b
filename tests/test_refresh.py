"""A refreshed store equals a full rebuild, and untouched partitions keep their files."""

import csv
import os

import pytest

from fundlens.sources import refresh as R

SCHEMA = "id long, country string, goal double, blurb string"


def put(folder, name, rows):
    with open(folder / name, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["id", "country", "goal", "blurb"])
        w.writerows(rows)


def files_of(store):
    return {os.path.join(os.path.basename(d), f) for d, _, names in os.walk(store) for f in names if f.endswith(".parquet") and "country=" in d}


def test_refresh_equals_a_rebuild(spark, tmp_path):
    folder, schema = tmp_path / "csv", spark.createDataFrame([], SCHEMA).schema
    folder.mkdir()
    clean = lambda df: df.filter("goal > 0")

    def both(n):
        got = R.refresh(spark, str(folder), f"{tmp_path}/store", schema, clean)
        R.refresh(spark, str(folder), f"{tmp_path}/full{n}", schema, clean)
        rows = [sorted(map(tuple, spark.read.schema(SCHEMA + ", source_file string").parquet(f"{tmp_path}/{s}").drop("source_file").collect()))
                for s in ("store", f"full{n}")]
        assert rows[0] == rows[1]
        return got, rows[0], files_of(f"{tmp_path}/store")

    put(folder, "a.csv", [(1, "DE", 5, "x\ny"), (2, "FR", 6, 'say "z"'), (3, "FR", 0, "not valid"), (4, "US", 1, "")])
    put(folder, "b.csv", [(5, "US", 7, "b"), (6, "IT", 8, "b")])
    got, rows, first = both(0)
    assert got == {"added": 2, "removed": 0, "partitions": 4} and [r[0] for r in rows] == [1, 2, 4, 5, 6]
    assert R.refresh(spark, str(folder), f"{tmp_path}/store", schema, clean) == {"added": 0, "removed": 0, "partitions": 0}
    assert files_of(f"{tmp_path}/store") == first

    put(folder, "c.csv", [(7, "US", 9, "new\nline"), (8, "ES", 2, "new")])  # one file more
    got, rows, second = both(1)
    assert got == {"added": 1, "removed": 0, "partitions": 2} and len(rows) == 7
    untouched = {f for f in first if not f.startswith("country=US")}
    assert untouched <= second and not {f for f in first if f.startswith("country=US")} & second

    put(folder, "b.csv", [(5, "US", 70, "changed a lot"), (9, "FR", 1, "b")])  # a changed file: IT has no row any more
    got, rows, third = both(2)
    assert got == {"added": 1, "removed": 1, "partitions": 3}
    assert (5, 70.0) in {(r[0], r[1]) for r in rows} and not any(f.startswith("country=IT") for f in third)
    assert {f for f in second if f.startswith(("country=DE", "country=ES"))} <= third

    os.remove(folder / "a.csv")
    got, rows, _ = both(3)
    assert got["removed"] == 1 and sorted(r[0] for r in rows) == [5, 7, 8, 9]


def test_a_refresh_that_broke_off_is_run_again(spark, tmp_path, monkeypatch):
    folder, schema, store = tmp_path / "csv", spark.createDataFrame([], SCHEMA).schema, f"{tmp_path}/store"
    folder.mkdir()
    put(folder, "a.csv", [(1, "DE", 5, "x"), (2, "FR", 6, "y"), (3, "US", 1, "z")])
    R.refresh(spark, str(folder), store, schema, lambda df: df)
    put(folder, "b.csv", [(4, "DE", 7, "b"), (5, "FR", 8, "b")])
    old = R.write_partitioned

    def breaks(rows, *args, **more):  # one partition is replaced, the other isn't
        old(rows.filter("country = 'DE'"), *args, **more)
        raise RuntimeError("lost")

    monkeypatch.setattr(R, "write_partitioned", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        R.refresh(spark, str(folder), store, schema, lambda df: df)
    monkeypatch.setattr(R, "write_partitioned", old)
    assert R.refresh(spark, str(folder), store, schema, lambda df: df) == {"added": 1, "removed": 0, "partitions": 2}
    rows = spark.read.parquet(store).select("id", "country").collect()
    assert sorted(map(tuple, rows)) == [(1, "DE"), (2, "FR"), (3, "US"), (4, "DE"), (5, "FR")]
    assert R.refresh(spark, str(folder), store, schema, lambda df: df)["partitions"] == 0
