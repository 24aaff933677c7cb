"""Column expressions for cleaning (P1-P4, P9). Pure built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import sentinel_flag_name


def nan_to_null(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def clip_log1p(c: str | Column) -> Column:
    """``x < 0 -> 0.0`` then ``log1p``; null stays null and NaN stays NaN."""
    col = F.col(c) if isinstance(c, str) else c
    return F.log1p(F.when(col < 0, F.lit(0.0)).otherwise(col))


def was_missing(c: str) -> Column:
    """1.0 when the value is null (or NaN), else 0.0."""
    col = F.col(c)
    return (col.isNull() | F.isnan(col)).cast("double")


def is_value(c: str, value: float) -> Column:
    """1.0 when ``c == value``; null compares as 0.0 (pandas semantics)."""
    return F.coalesce((F.col(c) == F.lit(value)).cast("double"), F.lit(0.0))


def fill_token(c: str, token: str = "missing") -> Column:
    return F.coalesce(F.col(c), F.lit(token))


def token(c: str) -> Column:
    """``"col=value"``; null-propagating (fill first when a token is wanted)."""
    return F.concat(F.lit(f"{c}="), F.col(c))


def sentinel_exprs(col: str, values) -> dict[str, Column]:
    return {sentinel_flag_name(col, v): is_value(col, v) for v in values}
