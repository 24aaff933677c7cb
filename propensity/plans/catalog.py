"""Registered queries: one per operator of the inventory, each reading the
driver's tables through the ``ctr`` fixture view, with the DuckDB SQL that
must give the same table (``None``: no SQL form; rows-only check).

Doubles are rounded to 6 decimals on both sides (4 for fitted logistic
regression), counts are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import CTR_SPEC, with_ctr
from ..functions.hashing import md5_u32_sql
from ..operators.split import hash_limit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

S = CTR_SPEC
INTS = list(S.int_cols)
CATS = list(S.cat_cols)
FEATURES = INTS + CATS


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctr(sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for comparison with SQL)."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def union_sql(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


#: md5 values of the row key by purpose, and the limits of fractions of 2^32.
H_SAMPLE, H_SPLIT, H_FOLD = (md5_u32_sql("row_id", f"42:{p}") for p in ("sample", "split", "fold"))
HALF, EIGHTY = (hash_limit(f) for f in (0.5, 0.8))
