"""Distributed dictionary encoding against MLlib's indexer."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from fundlens.operators import encoding as EN


@pytest.fixture(scope="module")
def words(spark):
    rows = [(i, None if i % 13 == 0 else ("hot" if i % 3 == 0 else f"w{i * i % 97}")) for i in range(2000)]
    return spark.createDataFrame(rows, "id long, c string").repartition(7)


@pytest.mark.parametrize("order", EN.ORDERS)
@pytest.mark.parametrize("max_broadcast", [0, EN.MAX_BROADCAST])
def test_equals_string_indexer(spark, words, order, max_broadcast):
    got = EN.encode(words, ["c"], order, max_broadcast=max_broadcast)
    want = StringIndexer(inputCol="c", outputCol="c_index", handleInvalid="keep", stringOrderType=order).fit(words).transform(words)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)


def test_a_million_labels_in_ranges(spark):
    n = 1_000_000
    df = spark.range(n).select(F.concat(F.lit("label"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"))
    df = df.unionByName(df.filter("substr(c, -1) = '7'"))  # every tenth twice
    codes = EN.dictionary(df, "c")
    twice, place = F.substr("c", F.lit(-1)) == "7", F.substr("c", F.lit(6), F.lit(7)).cast("long")
    codes = codes.withColumnRenamed("value", "c")
    # Labels found twice come first, each group by value.
    tens, last = F.floor(place / 10), place % 10
    want = F.when(twice, tens).otherwise(n // 10 + tens * 9 + last - (last > 7).cast("int"))
    assert codes.count() == n and codes.filter(F.col("code") != want).count() == 0
    assert codes.rdd.getNumPartitions() > 1


def test_unseen_values(spark, words):
    own = EN.dictionary(words, "c")
    other = spark.createDataFrame([(1, "hot"), (2, "new"), (3, None)], "id long, c string")
    got = {r.id: r.c_index for r in EN.encode(other, ["c"], dictionaries={"c": own}).collect()}
    assert got[1] == 0.0 and got[2] == got[3] == own.count()
    skipped = EN.encode(other, ["c"], handle_invalid="skip", dictionaries={"c": own}).collect()
    assert [r.id for r in skipped] == [1]
    with pytest.raises(Exception, match="no code for"):
        EN.encode(other, ["c"], handle_invalid="error", dictionaries={"c": own}).collect()
    with pytest.raises(ValueError, match="order"):
        EN.dictionary(words, "c", "random")


def test_empty_table(spark, words):
    none = words.limit(0)
    assert EN.dictionary(none, "c").count() == 0 and EN.encode(none, ["c"]).count() == 0
    only_null = words.filter("c IS NULL")
    assert {r.c_index for r in EN.encode(only_null, ["c"]).collect()} == {0.0}
