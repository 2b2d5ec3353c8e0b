"""Feature operators (§2.11)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import clean as K
from ..operators import encoding as EN
from ..operators import features as FT
from ..operators import profile as P
from .oracle import FEATURES_CTE, VALIDATED_CTE, bucket_sql, index_sql, with_campaigns
from .q_clean import feature_table, model_table
from .registry import register

S = "features"
VF = VALIDATED_CTE + ",\n" + FEATURES_CTE
IDX_FREQ = VF + f""",
cat_idx AS ({index_sql('category', 'features')}),
ctr_idx AS ({index_sql('country', 'features')})"""
IDX_ALPHA = VF + f""",
cat_idx AS ({index_sql('category', 'features', True)}),
ctr_idx AS ({index_sql('country', 'features', True)})"""
ASSEMBLED = """SELECT f.id, ROUND(ln(1 + f.goal), 6) AS f_goal_log, CAST(f.duration AS DOUBLE) AS f_duration,
       CAST(f.staff_pick AS DOUBLE) AS f_staff_pick, a.idx AS f_category_index, b.idx AS f_country_index
FROM features f JOIN cat_idx a ON f.category = a.v JOIN ctr_idx b ON f.country = b.v"""


def _validated(spark, sf):
    return K.validate(model_table(spark, sf)).withColumn("staff_pick", F.col("staff_pick").cast("int")) \
        .withColumn("duration", F.col("deadline") - F.col("launched_at"))


@register("log_goal_transformer", with_campaigns(
    "SELECT id, ROUND(ln(1 + goal), 6) AS goal_log FROM features", VF), S)
def log_goal_transformer(spark, sf):
    out = FT.LogGoalTransformer(inputCol="goal", outputCol="goal_log").transform(_validated(spark, sf))
    return out.select("id", F.round("goal_log", 6).alias("goal_log"))


def _indexed(spark, sf, order):
    return EN.encode(_validated(spark, sf), FT.CATEGORICAL, order).select("id", "category_index", "country_index")


@register("index_frequency", with_campaigns("""
SELECT f.id, a.idx AS category_index, b.idx AS country_index
FROM features f JOIN cat_idx a ON f.category = a.v JOIN ctr_idx b ON f.country = b.v""", IDX_FREQ), S)
def index_frequency(spark, sf):
    return _indexed(spark, sf, "frequencyDesc")


@register("index_alphabetical", with_campaigns("""
SELECT f.id, a.idx AS category_index, b.idx AS country_index
FROM features f JOIN cat_idx a ON f.category = a.v JOIN ctr_idx b ON f.country = b.v""", IDX_ALPHA), S)
def index_alphabetical(spark, sf):
    return _indexed(spark, sf, "alphabetAsc")


def _elements(df):
    arr = vector_to_array(F.col("features"))
    return df.select("id", F.round(arr[0], 6).alias("f_goal_log"),
                     *[arr[i].alias(f"f_{n}") for i, n in enumerate(FT.FEATURE_COLS) if i > 0])


@register("assemble_features", with_campaigns(ASSEMBLED, IDX_FREQ), S)
def assemble_features(spark, sf):
    df = FT.LogGoalTransformer().transform(_validated(spark, sf))
    idx = Pipeline(stages=FT.indexers()).fit(df).transform(df)
    return _elements(FT.assembler().transform(idx))


@register("feature_pipeline", with_campaigns(ASSEMBLED, IDX_FREQ), S)
def feature_pipeline(spark, sf):
    df = _validated(spark, sf)
    return _elements(FT.feature_pipeline().fit(df).transform(df))


@register("bucketize", with_campaigns(
    f"SELECT id, {bucket_sql('goal', P.GOAL_SPLITS)} AS goal_bucket, "
    f"{bucket_sql('goal_log', P.GOAL_LOG_SPLITS)} AS goal_log_bucket FROM features", VF), S)
def bucketize(spark, sf):
    df = feature_table(spark, sf)
    df = P.bucketize(P.bucketize(df, "goal", "goal_bucket", P.GOAL_SPLITS), "goal_log", "goal_log_bucket",
                     P.GOAL_LOG_SPLITS)
    return df.select("id", "goal_bucket", "goal_log_bucket")
