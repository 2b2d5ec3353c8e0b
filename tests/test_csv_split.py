"""Multi-line CSV in splits equals the read of whole files."""

import csv
import io
import random

import pytest

from fundlens.session import scratch_path
from fundlens.sources import csv_split
from fundlens.sources import files as IO

SCHEMA = "id long, blurb string, goal double, name string"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def written(tmp_path, files, end="\n", bom=""):
    folder = tmp_path / f"csv{len(list(tmp_path.iterdir()))}"
    folder.mkdir()
    for n, rows in enumerate(files):
        out = io.StringIO()
        w = csv.writer(out, lineterminator=end)
        w.writerow(["id", "blurb", "goal", "name"])
        w.writerows(rows)
        (folder / f"part-{n}.csv").write_bytes((bom + out.getvalue()).encode())
    return str(folder)


def text(r):
    return "".join(r.choice(['"', "\n", ",", "a", "bc ", "é", '""', "\n\n", "x" * r.randint(0, 40)]) for _ in range(r.randint(0, 12)))


def rows_of(r, n):
    return [(i, text(r), r.choice(["", "1.5", "oops"]), text(r)) for i in range(n)]


def same(spark, path, schema=SCHEMA, **more):
    of = spark.createDataFrame([], schema).schema
    got = IO.read_campaigns_csv(spark, path, of, **more)
    want = IO.read_campaigns_csv(spark, path, of, split=False, **more)
    assert got.columns == want.columns and got.schema == want.schema
    key = lambda r: tuple((x is not None, x) for x in r)
    found = sorted(map(tuple, got.collect()), key=lambda r: str(r))
    assert found == sorted(map(tuple, want.collect()), key=lambda r: str(r))
    return found


@pytest.mark.parametrize("size", [16, 150, 4000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_whole_files(spark, tmp_path, small_splits, size, end):
    r = random.Random(size)
    path = written(tmp_path, [rows_of(r, 60), [], rows_of(r, 25)], end)
    small_splits(size)
    if size < 4000:
        assert csv_split.numbered_lines(spark, path).rdd.getNumPartitions() > 3
    found = same(spark, path)
    assert len(found) == 85


def test_a_field_over_many_splits(spark, tmp_path, small_splits):
    small_splits(64)
    long = "\n".join(f'line "{n}", with a comma' for n in range(400))
    rows = [(1, "short", "2", "a"), (2, long, "3", long), (3, "x\r\ny", "4", 'say ""'), (4, "\n", "5", "\n\n")]
    found = same(spark, written(tmp_path, [rows]))
    assert [f[1] for f in found] == [t[1] for t in rows] and found[1][3] == long


def test_corrupt_records_missing_columns_and_order(spark, tmp_path, small_splits):
    small_splits(32)
    path = written(tmp_path, [[(1, "a\nb", "oops", "n"), (2, "c", "1", "m")]])
    found = same(spark, path, "goal double, extra string, id long", keep_corrupt=True)
    assert (None, None, 1) in [f[:3] for f in found] and sum(f[3] is not None for f in found) == 1
    with pytest.raises(ValueError, match="extra"):
        IO.read_campaigns_csv(spark, path, spark.createDataFrame([], "extra string").schema, required=["extra"])


def test_blank_lines_unfinished_field_and_mark(spark, tmp_path, small_splits):
    small_splits(24)
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a.csv").write_bytes('\ufeffid,blurb,goal,name\n1,a,2,b\n\n\n2,"x\ny",3,"c"\n3,d,4,e'.encode())
    found = same(spark, str(folder))
    assert [f[0] for f in found] == [1, 2, 3]


def test_files_with_other_headers_fail(spark, tmp_path):
    path = written(tmp_path, [[(1, "a", "2", "b")]])
    with open(f"{path}/part-9.csv", "w") as f:
        f.write("id,name,goal,blurb\n1,a,2,b\n")
    with pytest.raises(Exception, match="header"):
        IO.read_campaigns_csv(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()


def test_empty_files(spark, tmp_path):
    assert same(spark, written(tmp_path, [[], []])) == []
    folder = tmp_path / "nothing"
    folder.mkdir()
    (folder / "a.csv").write_text("")
    of = spark.createDataFrame([], SCHEMA).schema
    assert IO.read_campaigns_csv(spark, str(folder), of).collect() == []


def test_moved_splits_are_an_error(spark, tmp_path, monkeypatch):
    path = written(tmp_path, [[(n, "a\nb", "2", "b") for n in range(30)]])
    lines = csv_split.numbered_lines(spark, path)
    old = csv_split.splits
    monkeypatch.setattr(csv_split, "splits", lambda x: old(x).filter("start < 0"))
    with pytest.raises(Exception, match="minPartitionNum"):
        csv_split.records(spark, path).collect()
    assert lines.count() > 60


def test_written_table_round_trip_uses_all_splits(spark, small_splits):
    df = spark.range(3000).selectExpr("id", "concat('say \"', id, '\"\n', repeat('z', 50)) AS blurb", "CAST(id AS double) AS goal",
                                      "'n' AS name").coalesce(1)
    path = IO.write_csv(df, scratch_path(spark, "one_file"))
    small_splits(20_000)
    back = IO.read_campaigns_csv(spark, path, df.schema)
    assert csv_split.numbered_lines(spark, path).rdd.getNumPartitions() >= 8
    assert back.count() == 3000 and back.exceptAll(df).count() == 0
