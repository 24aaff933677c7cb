"""Feature operators (E1-E9, A12-A15 as fitted statistics).

The canonical preprocessing is four MLlib stages (median imputer, feature
hasher, assembler, unit-variance scaler), kept as MLlib stages so a fitted
pipeline saves and loads in MLlib's format. Next to them are native-column
forms used where an exact, SQL-checkable result is wanted: exact medians,
md5 signed hashing and scalers with sample or population deviation. Fitting
is always one aggregate whose small result (one value per column) becomes
literals of the transform; no UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (FeatureHasher, Imputer, OneHotEncoder, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import md5_token_u32
from ..spec import FeatureSpec
from .quantiles import exact_quantiles



# ------------------------------------------------------------ E1 imputers
def median_imputer(cols, relative_error: float = 0.001, suffix: str = "_imp") -> Imputer:
    """E1, MLlib form: approximate median (an actual element), fills null
    and NaN into ``<c>_imp``; raises on a column without values."""
    return Imputer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                   strategy="median", relativeError=relative_error)


def fit_medians(df: DataFrame, cols, interpolation: str = "linear",
                fallback: float | None = 0.0) -> dict[str, float | None]:
    """Exact medians per column (``"linear"``: midpoint, the single-machine
    twin's imputer; ``"lower"``: the element MLlib's imputer picks at relative
    error 0). A column without values gets ``fallback``."""
    q = exact_quantiles(df, list(cols), [0.5], interpolation=interpolation)
    return {c: (q[(c, 0.5)] if q[(c, 0.5)] is not None else fallback) for c in cols}


def impute(df: DataFrame, medians: dict[str, float | None], suffix: str = "_imp") -> DataFrame:
    """E1, native form: ``<c>_imp = coalesce(nanvl(c, null), median)``."""
    def fill(c: str) -> Column:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        return F.coalesce(x, F.lit(medians[c]).cast("double"))
    return df.withColumns({f"{c}{suffix}": fill(c) for c in medians})


# ------------------------------------------------------------ E2/E3 hashing
def feature_hasher(cols, num_features: int, output: str = "cat_features") -> FeatureHasher:
    """MLlib's hasher: ``"col=value"`` tokens, value 1.0, collisions add,
    null skipped."""
    return FeatureHasher(inputCols=list(cols), outputCol=output, numFeatures=num_features)


def _signed_hits(cols) -> Column:
    """Per row: array of (bucket hash, sign) for each non-null ``col=value``."""
    def hit(c: str) -> Column:
        tok = F.concat(F.lit(f"{c}="), F.col(c))
        sign = F.lit(1.0) - 2.0 * (F.conv(F.substring(F.md5(tok), 9, 1), 16, 10).cast("int") % 2)
        return F.when(F.col(c).isNotNull(), F.struct(md5_token_u32(tok).alias("h"), sign.alias("s")))
    return F.filter(F.array(*[hit(c) for c in cols]), lambda x: x.isNotNull())


def signed_hash_long(df: DataFrame, cols, num_features: int, key: str) -> DataFrame:
    """E3, long form ``(key, bucket, value)``: bucket = md5 digits 1-8 mod
    n, sign from the low bit of digit 9; entries that cancel to 0 are
    dropped. Used as the SQL-checkable form (it shuffles by key)."""
    hits = df.select(key, F.explode(_signed_hits(cols)).alias("x"))
    return (hits.groupBy(key, (F.col("x.h") % num_features).cast("int").alias("bucket"))
                .agg(F.sum("x.s").alias("value"))
                .where(F.col("value") != 0))


#: The one way from columns to a sparse vector column inside the JVM: the vector type's own fields, as text.
_VECTOR = T.StructType([T.StructField("v", VectorUDT())])


def sparse_vector(indices: Column, values: Column, size: int) -> Column:
    """A sparse vector column from ascending indices and their values."""
    fields = F.struct(F.lit(0).alias("type"), F.lit(int(size)).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), _VECTOR)["v"]


def sparse_entries(vector: Column) -> Column:
    """array<struct<index, value>> of a sparse vector column, without a dense pass."""
    v = F.from_json(F.to_json(F.struct(vector.alias("v"))), "v struct<indices: array<int>, values: array<double>>")["v"]
    return F.arrays_zip(v["indices"].alias("index"), v["values"].alias("value"))


def signed_hash_vector(df: DataFrame, cols, num_features: int, output: str = "signed_features") -> DataFrame:
    """E3, vector form without a shuffle or UDF: the row's few signed hits are
    summed by bucket and become the sorted indices and values of a sparse
    vector, so memory follows the non-zero entries, not ``num_features``."""
    n = F.lit(int(num_features))
    hits = F.transform(_signed_hits(cols), lambda x: F.struct((x["h"] % n).cast("int").alias("b"), x["s"].alias("s")))

    def entries(h: Column) -> Column:
        total = lambda b: F.aggregate(F.filter(h, lambda x: x["b"] == b), F.lit(0.0), lambda acc, x: acc + x["s"])
        buckets = F.array_sort(F.array_distinct(F.transform(h, lambda x: x["b"])))
        return F.filter(F.transform(buckets, lambda b: F.struct(b.alias("b"), total(b).alias("v"))), lambda x: x["v"] != 0)
    # one-element arrays bind the hits and the entries, so each is made once a row
    bound = F.transform(F.transform(F.array(hits), entries), lambda e: sparse_vector(
        F.transform(e, lambda x: x["b"]), F.transform(e, lambda x: x["v"]), num_features))
    return df.withColumn(output, F.element_at(bound, 1)).withMetadata(output, {"ml_attr": {"num_attrs": int(num_features)}})


# ------------------------------------------------------------ E4-E7
def assembler(inputs, output: str = "raw_features", handle_invalid: str = "error") -> VectorAssembler:
    """Concatenate imputed numerics, passthrough indicators and the
    hashed block; null/NaN raise (``handleInvalid="error"``) as in the
    reference."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid)


def unit_variance_scaler(input_col: str = "raw_features", output: str = "features") -> StandardScaler:
    """E5, MLlib form: divide by the sample standard deviation, no centring;
    a constant feature becomes 0.0."""
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=False, withStd=True)


@dataclass
class ColumnScaler:
    """E5/E6, native form on numeric columns.

    ``ddof=1``: sample deviation, constant column -> 0.0 (MLlib's scaler);
    ``ddof=0``: population deviation, constant column kept as is (the
    single-machine twin's scaler)."""
    stds: dict
    ddof: int = 1
    suffix: str = ""

    @classmethod
    def fit(cls, df: DataFrame, cols, ddof: int = 1, suffix: str = "") -> "ColumnScaler":
        fn = F.stddev_samp if ddof == 1 else F.stddev_pop
        row = df.agg(*[fn(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        return cls({c: row[f"s{i}"] for i, c in enumerate(cols)}, ddof, suffix)

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, s in self.stds.items():
            x = F.col(c).cast("double")
            if s is None or s == 0.0:
                out[f"{c}{self.suffix}"] = F.lit(0.0) * x if self.ddof == 1 else x
            else:
                out[f"{c}{self.suffix}"] = x / F.lit(float(s))
        return df.withColumns(out)


# ------------------------------------------------------------ E8/E9
def preprocessing_stages(spec: FeatureSpec, relative_error: float = 0.001,
                         indicators: bool = False, num_features: int | None = None,
                         style: str = "canonical") -> list:
    """E8 without the classifier: imputer -> hasher -> assembler -> scaler.

    ``indicators=True`` puts the missingness/sentinel flags between the
    numerics and the hashed block, un-imputed (E7). ``style="twin"`` gives
    the single-machine twin's stages instead (exact median, signed hashing,
    population scaling, indicators always in; see ``twin``)."""
    if style == "twin":
        from .twin import twin_preprocessing_stages
        return twin_preprocessing_stages(spec, num_features)
    n = num_features or spec.num_hash_features
    inputs = (list(spec.imputed_cols) + (list(spec.indicator_cols) if indicators else [])
              + (["cat_features"] if spec.cat_cols else []))
    stages = []
    if spec.int_cols:
        stages.append(median_imputer(spec.int_cols, relative_error))
    if spec.cat_cols:
        stages.append(feature_hasher(spec.cat_cols, n))
    return stages + [assembler(inputs), unit_variance_scaler()]


def index_one_hot(col: str, output: str | None = None, drop_last: bool = True) -> list:
    """String index (frequency order, unseen -> an extra index) then
    one-hot encoding."""
    out = output or f"{col}_vec"
    return [StringIndexer(inputCol=col, outputCol=f"{col}_idx", handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[out], dropLast=drop_last,
                          handleInvalid="keep")]


def preprocessing_pipeline(spec: FeatureSpec, **kw) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(spec, **kw))
