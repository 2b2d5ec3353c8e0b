"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of each id in the links (a, b); the component is its least id.

    Each round joins every node's neighbours to the least of them, first the
    larger ones, then all; the rounds needed grow with the logarithm of the
    largest component. The links of each round are a written table, so no
    lineage piles up, and nothing but counts reaches the driver.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # A node's larger neighbours go to the least around it (that is, to itself if none is less).
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small_least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = written(small, "links")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
