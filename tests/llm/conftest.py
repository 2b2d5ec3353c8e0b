import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
#: Texts of every defined case: nulls, empty and blank ones, ties and repeats, odd characters, no spaces.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Four Words Are few"),
    (6, "one two three four five six"), (7, "ONE two\tthree four\nfive six"), (7, "ONE two\tthree four\nfive six"),
    (8, "x" * 70_000), (9, "naïve 漢字 😀 é" * 30), (10, "a b " * 20_000), (11, "\x00\x01 ok   end"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Documents of every case, with further columns of clashing names."""
    rows = [(i, t, "id", "x", "h", 1, None) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, _id string, h string, n int, _t string")


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="session")
def sf():
    assert os.path.isdir(SF)
    return SF
