"""Fitted tree ensembles as a table of nodes, and scoring by one column expression.

A node is a row: its tree and number, the feature it splits by with a threshold or the category codes
that go left, its children, and its value. Trees that vote (decision tree, random forest) have the share of the
positive class as value, boosted ones their prediction times the tree's weight. The table is
plain Parquet, so a model can be read, joined and scored without the library that fitted it.

Scoring turns each tree into nested CASE expressions over named columns; no row goes through Python or
a model object. The nodes are collected for that: they are as many as the
model has, which fitting held on the driver too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .features import FEATURE_COLS
from .models import last_stage

NODE_SCHEMA = ("tree int, node int, feature string, threshold double, categories array<double>, n_categories int, "
               "left int, right int, value double, n long, gain double, votes boolean")
VOTING = ("DecisionTreeClassificationModel", "RandomForestClassificationModel")
BOOSTED = ("GBTClassificationModel",)


def node_table(model, features: Sequence[str] = FEATURE_COLS, spark: SparkSession | None = None) -> DataFrame:
    """The nodes of a fitted decision tree, random forest or boosted trees (or a pipeline that ends in one),
    read from what the model writes."""
    spark = spark or SparkSession.getActiveSession()
    stage = last_stage(model)
    kind = type(stage).__name__
    if kind not in VOTING + BOOSTED:
        raise ValueError(f"not a tree model: {kind}")
    path = scratch_path(spark, "trees")
    stage.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    nodes = data.select("treeID", "nodeData.*") if "nodeData" in data.columns else data.withColumn("treeID", F.lit(0))
    leaf = F.col("leftChild") < 0
    categorical = ~leaf & (F.col("split.numCategories") >= 0)
    if kind in VOTING:
        total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
        value = F.try_divide(F.col("impurityStats")[1], total)
    else:
        weights = stage.treeWeights  # one for each tree
        value = F.col("prediction") * F.element_at(F.array(*map(F.lit, weights)), F.col("treeID") + 1)
    return nodes.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(~leaf, F.element_at(F.array(*map(F.lit, features)), F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(~leaf & ~categorical, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(categorical, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.when(categorical, F.col("split.numCategories")).alias("n_categories"),
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"),
        value.alias("value"), F.col("rawCount").alias("n"), F.when(~leaf, F.col("gain")).alias("gain"),
        F.lit(kind in VOTING).alias("votes"))


def _goes_left(n: Row, of: Mapping[str, Column]) -> Column:
    x = of[n["feature"]]
    if n["categories"] is None:
        return x <= F.lit(float(n["threshold"]))
    left = sorted(n["categories"])
    if len(left) <= n["n_categories"] // 2:
        return x.isin(left)
    # A code beyond those of the fit goes with the larger side.
    return ~x.isin(sorted(set(map(float, range(n["n_categories"]))) - set(left)))


def tree_value(nodes: Mapping[int, Row], of: Mapping[str, Column], at: int = 0) -> Column:
    """The value of the leaf that a row ends in, for one tree's nodes by number."""
    n = nodes[at]
    if n["left"] is None:
        return F.lit(float(n["value"]))
    return F.when(_goes_left(n, of), tree_value(nodes, of, n["left"])).otherwise(tree_value(nodes, of, n["right"]))


def _by_tree(rows: Sequence[Row], of: Mapping[str, Column] | None):
    trees: dict[int, dict[int, Row]] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["node"]] = r
    return trees, of or {c: F.col(c).cast("double") for c in {r["feature"] for r in rows} - {None}}


def tree_values(table: DataFrame | Sequence[Row], of: Mapping[str, Column] | None = None) -> tuple[list[Column], bool]:
    """An expression for each tree in order, and whether the trees vote."""
    rows = table.collect() if isinstance(table, DataFrame) else list(table)
    trees, of = _by_tree(rows, of)
    return [tree_value(trees[t], of) for t in sorted(trees)], bool(rows and rows[0]["votes"])


def leaf_values(table: DataFrame | Sequence[Row], leaves: Column) -> list[Column]:
    """The values of ``tree_values``, by the leaves' numbers that the model itself gives a row
    (``leafCol`` as an array: for each tree the place among its leaves, from left to right, as nodes are numbered)."""
    rows = table.collect() if isinstance(table, DataFrame) else list(table)
    trees, _ = _by_tree(rows, {})
    return [F.element_at(F.array(*[F.lit(float(trees[t][n]["value"])) for n in sorted(trees[t]) if trees[t][n]["left"] is None]),
                         leaves[i].cast("int") + 1) for i, t in enumerate(sorted(trees))]


def _total(columns: Sequence[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


def score(columns: Sequence[Column], votes: bool) -> Column:
    """Probability of the positive class: the mean vote, or the logistic function of twice the sum."""
    total = _total(columns)
    return total / F.lit(float(len(columns))) if votes else F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))


def score_table(df: DataFrame, table: DataFrame | Sequence[Row], score_col: str = "score",
                prediction_col: str = "prediction") -> DataFrame:
    """Add the score of a node table and its prediction; the features are columns of ``df``."""
    columns, votes = tree_values(table)
    return df.withColumn(score_col, score(columns, votes)).withColumn(
        prediction_col, F.when(F.col(score_col) > 0.5, 1.0).otherwise(0.0))


def staged_scores(df: DataFrame, columns: Sequence[Column], rounds: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """(``keep`` columns, rounds, score): boosted trees after each number of rounds. The sums are plain columns of one
    projection, which share what they have in common, so every tree is evaluated once."""
    sums = [score(columns[:n], False).alias(f"_s{n}") for n in rounds]
    each = F.array(*[F.struct(F.lit(n).alias("rounds"), F.col(f"_s{n}").alias("score")) for n in rounds])
    return df.select(*keep, *sums).select(*keep, F.explode(each).alias("s")).select(*keep, "s.*")


def _path(nodes: Mapping[int, Row], of: Mapping[str, Column], at: int = 0, before: tuple[int, ...] = ()) -> Column:
    """The numbers of all nodes that a row passes in one tree."""
    n, passed = nodes[at], (*before, at)
    if n["left"] is None:
        return F.array(*map(F.lit, passed))
    return F.when(_goes_left(n, of), _path(nodes, of, n["left"], passed)).otherwise(_path(nodes, of, n["right"], passed))


def on_rows(df: DataFrame, table: DataFrame, label: str) -> DataFrame:
    """The node table with ``n`` and ``gain`` (decrease of Gini impurity by each split) of the rows of ``df`` with a 0/1 label."""
    trees, of = _by_tree(table.collect(), None)

    def visits(t: int) -> Column:
        return F.transform(_path(trees[t], of), lambda x: F.struct(F.lit(t).alias("tree"), x.alias("node")))

    passed = F.concat(*map(visits, sorted(trees)))
    counts = (df.filter(F.col(label).isNotNull()).select(F.explode(passed).alias("v"), F.col(label).cast("long").alias("y"))
              .groupBy("v.tree", "v.node").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("p")))
    # From here on a row for each node.
    counted = table.drop("n", "gain").join(counts, ["tree", "node"], "left").fillna(0, ["c", "p"])
    own = counted.select("tree", F.col("node").alias("child"), F.struct("c", "p").alias("s"))
    for side in ("left", "right"):
        counted = counted.join(own.select("tree", F.col("child").alias(side), F.col("s").alias(f"_{side}")), ["tree", side], "left")

    def gini(c: Column, p: Column) -> Column:
        share = F.coalesce(F.try_divide(p.cast("double"), c.cast("double")), F.lit(0.0))
        return 1 - share * share - (1 - share) * (1 - share)

    part = lambda side: F.coalesce(F.try_divide(F.col(f"_{side}.c").cast("double"), F.col("c").cast("double")), F.lit(0.0)) * gini(
        F.col(f"_{side}.c"), F.col(f"_{side}.p"))
    gain = F.when(F.col("left").isNotNull(), gini(F.col("c"), F.col("p")) - part("left") - part("right"))
    return counted.withColumn("n", F.col("c")).withColumn("gain", gain).select(table.columns)


def importances(table: DataFrame, features: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """(feature, importance, rank): gain times rows of each feature's splits, for voting trees
    as a share of its tree first, and then as a share of all trees."""
    gains = table.filter("left IS NOT NULL").withColumn("g", F.col("gain") * F.col("n"))
    of_tree = F.when(F.col("votes"), F.sum("g").over(Window.partitionBy("tree"))).otherwise(1.0)
    shares = gains.withColumn("s", F.try_divide(F.col("g"), of_tree)).groupBy("feature").agg(F.sum("s").alias("s"))
    names = table.sparkSession.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, place int")
    every = Window.partitionBy(F.lit(0))  # a row for each feature
    total = F.sum("s").over(every)
    found = names.join(shares, "feature", "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    found = found.withColumn("importance", F.round(F.coalesce(F.try_divide(F.col("s"), total), F.lit(0.0)), 6))
    return found.select("feature", "importance", F.row_number().over(every.orderBy(F.desc("importance"), "place")).alias("rank"))
