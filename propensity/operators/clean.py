"""Cleaning (P1-P4, P9) as single projections.

The reference chains one ``withColumn`` per column (~76 projections); here
each step is one ``withColumns``/``select`` so the analyzer sees one node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as X
from ..spec import FeatureSpec


def fill_missing(df: DataFrame, cols, token: str = "missing") -> DataFrame:
    """Null category -> ``token``."""
    cols = [c for c in cols if c in df.columns]
    return df.fillna(token, subset=cols) if cols else df


def log1p_clip(df: DataFrame, cols) -> DataFrame:
    """``log1p(max(x, 0))`` in place; null and NaN pass through."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({c: X.clip_log1p(c) for c in cols}) if cols else df


def missing_flags(df: DataFrame, cols) -> DataFrame:
    """``<c>_was_missing`` 1.0/0.0, to be taken before any fill."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({f"{c}_was_missing": X.was_missing(c) for c in cols}) if cols else df


def sentinel_flags(df: DataFrame, col: str | None, values) -> DataFrame:
    """``<col>_is_neg1`` etc., 1.0 where ``col == value`` before the clip."""
    if col is None or col not in df.columns or not values:
        return df
    return df.withColumns(X.sentinel_exprs(col, values))


def row_tokens(df: DataFrame, cols, keep=()) -> DataFrame:
    """``tok_<c> = "c=value"`` for each categorical column."""
    return df.select(*keep, *[X.token(c).alias(f"tok_{c}") for c in cols])


def clean(df: DataFrame, spec: FeatureSpec, indicators: bool = False) -> DataFrame:
    """The cleaning step of the canonical job: fill categories, clip+log1p the
    skewed columns. With ``indicators=True`` (the single-machine twin),
    missingness and sentinel flags are taken first, from the raw values."""
    exprs = {}
    if indicators:
        exprs.update({f"{c}_was_missing": X.was_missing(c) for c in spec.flag_cols if c in df.columns})
        if spec.sentinel_col and spec.sentinel_col in df.columns:
            exprs.update(X.sentinel_exprs(spec.sentinel_col, spec.sentinels))
    exprs.update({c: X.fill_token(c, spec.missing_token) for c in spec.cat_cols if c in df.columns})
    exprs.update({c: X.clip_log1p(c) for c in spec.skewed if c in df.columns})
    # flags read the raw column values: all expressions are evaluated against
    # the input row of this one projection, so order of definition is moot.
    return df.withColumns(exprs)
