"""Every exactly checkable key equals its DuckDB oracle at sf0.001."""

import pytest

from conftest import SF_SMALL
from helpers import duck_rows, rows_of

from fundlens.plans import registry

SPECS = registry.load_all()
EXACT = sorted(k for k, v in SPECS.items() if v.sql)


DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("key", EXACT)
def test_matches_oracle(spark, duck_small, key):
    df = SPECS[key].build(spark, SF_SMALL)
    got = rows_of(df)
    want = duck_rows(duck_small, SPECS[key].sql, df.columns)
    assert len(got) == len(want)
    assert got == want
    rel = duck_small.sql(SPECS[key].sql)
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types


def test_entry_contract(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 100
