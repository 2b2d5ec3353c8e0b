"""Feature operators: the log-goal pipeline stage, indexers, assembler, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURE_COLS = ["goal_log", "duration", "staff_pick", "category_index", "country_index"]
CATEGORICAL = ["category", "country"]


class LogGoalTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: ``outputCol = log1p(inputCol)``.

    Lives in an importable module so pipelines holding it save and load
    (the Python-side params writer records the class path). The transform is
    a single Catalyst expression; no row crosses into Python.
    """

    @keyword_only
    def __init__(self, inputCol: str = "goal", outputCol: str = "goal_log"):
        super().__init__()
        self._setDefault(inputCol="goal", outputCol="goal_log")
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, inputCol: str = "goal", outputCol: str = "goal_log"):
        return self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.log1p(F.col(self.getInputCol())))


def indexers(cols: Sequence[str] = CATEGORICAL, handle_invalid: str = "keep",
             order: str = "frequencyDesc") -> list[StringIndexer]:
    """One multi-column StringIndexer (all label counts in a single pass):
    frequency desc then value asc by default; ``keep`` maps NULL/unseen
    values to index = number of labels; ``error`` raises."""
    cols = list(cols)
    return [StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols],
                          handleInvalid=handle_invalid, stringOrderType=order)]


def assembler(cols: Sequence[str] = FEATURE_COLS, output: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid)


def feature_stages(handle_invalid: str = "keep", order: str = "frequencyDesc", with_log: bool = True) -> list:
    stages = [LogGoalTransformer(inputCol="goal", outputCol="goal_log")] if with_log else []
    return stages + indexers(CATEGORICAL, handle_invalid, order) + [assembler()]


def feature_pipeline(handle_invalid: str = "keep", order: str = "frequencyDesc") -> Pipeline:
    """Index + assemble (no estimator)."""
    return Pipeline(stages=feature_stages(handle_invalid, order))


def vector_elements(df: DataFrame, vec: str = "features", names: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """Expand a vector column into one double column per element."""
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec], *[arr[i].alias(f"f_{n}") for i, n in enumerate(names)])
