"""Preprocessing of the single-machine twin as pipeline stages.

The twin imputes with the exact midpoint median, hashes categories with
signed +-1 entries and scales by the population deviation, keeping a
constant feature as it is. Each of these is a pipeline stage here, so the
twin's whole model is one ``Pipeline`` that fits, saves and loads like the
canonical one:

* ``ExactMedianImputer`` fits exact medians by narrowed brackets (see
  ``quantiles``) and returns a ``SQLTransformer`` that fills them (a stock MLlib
  stage, so the fitted medians save with the model);
* ``SignedHasher`` builds the signed hashed vector from built-in
  expressions (no UDF);
* ``PopulationScaler`` fits per-slot variance with MLlib's ``Summarizer``
  (one pass) and returns an ``ElementwiseProduct`` by 1/population std
  (1.0 for a constant slot).
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import FeatureSpec
from .features import assembler, fit_medians, signed_hash_vector


class ExactMedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A13 + E1: exact midpoint medians; fills null and NaN into ``<c>_imp``;
    a column without values gets 0.0."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cols = self.getInputCols()
        meds = fit_medians(df, cols, "linear", fallback=0.0)
        fills = ", ".join(
            f"coalesce(CASE WHEN isnan(CAST(`{c}` AS DOUBLE)) THEN NULL ELSE CAST(`{c}` AS DOUBLE) END, "
            f"CAST({float(meds[c])!r} AS DOUBLE)) AS `{c}_imp`" for c in cols)
        return SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")


class SignedHasher(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Signed hashed vector of ``"col=value"`` tokens (md5 bucket, md5 sign)."""

    numFeatures = Param(Params._dummy(), "numFeatures", "number of buckets",
                        typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="cat_features", numFeatures=128):
        super().__init__()
        self._setDefault(numFeatures=128, outputCol="cat_features")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return signed_hash_vector(df, self.getInputCols(), self.getOrDefault(self.numFeatures),
                                  self.getOutputCol())


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Divide each slot by its population deviation; a constant slot is
    kept unchanged."""

    @keyword_only
    def __init__(self, inputCol="raw_features", outputCol="features"):
        super().__init__()
        self._setDefault(inputCol="raw_features", outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        col = self.getInputCol()
        r = df.select(Summarizer.metrics("variance", "count").summary(F.col(col)).alias("s")).first()["s"]
        n = r["count"]
        scale = []
        for v in r["variance"].toArray():
            pop = v * (n - 1) / n if n > 1 else 0.0
            scale.append(1.0 / math.sqrt(pop) if pop > 0 else 1.0)
        return ElementwiseProduct(scalingVec=DenseVector(scale), inputCol=col, outputCol=self.getOutputCol())


def twin_preprocessing_stages(spec: FeatureSpec, num_features: int | None = None) -> list:
    """Imputer -> signed hasher -> assembler (numerics, indicators, hashes)
    -> population scaler: the twin's preprocessing as pipeline stages."""
    n = num_features or spec.num_hash_features
    inputs = list(spec.imputed_cols) + list(spec.indicator_cols) + (["cat_features"] if spec.cat_cols else [])
    stages = []
    if spec.int_cols:
        stages.append(ExactMedianImputer(inputCols=list(spec.int_cols)))
    if spec.cat_cols:
        stages.append(SignedHasher(inputCols=list(spec.cat_cols), outputCol="cat_features", numFeatures=n))
    return stages + [assembler(inputs), PopulationScaler()]
