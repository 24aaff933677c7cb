"""Deterministic per-row randomness that any SQL engine can reproduce.

Spark's ``rand``/``sampleBy``/``randomSplit`` and its hash functions have no
equivalent outside Spark, so every "random" decision that must be checked
against SQL is taken from md5 of ``"<seed>:<key>"``: the first 8 hex digits
are an unsigned 32-bit integer. All of it is JVM-side built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_string(key: Column | str, seed) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(f"{seed}:"), k.cast("string"))


def md5_hex(key: Column | str, seed, start: int = 1, length: int = 8) -> Column:
    return F.substring(F.md5(_key_string(key, seed)), start, length)


def md5_u32(key: Column | str, seed, start: int = 1) -> Column:
    """Unsigned 32-bit integer from hex digits ``start..start+7`` of md5."""
    return F.conv(md5_hex(key, seed, start, 8), 16, 10).cast("bigint")


def md5_u32_sql(key_sql: str, seed, start: int = 1) -> str:
    """The same value in DuckDB SQL (for oracles and docs)."""
    return (f"CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), "
            f"{start}, 8)) AS BIGINT)")


def md5_token_u32(token: Column, start: int = 1) -> Column:
    """Unsigned 32-bit integer from md5 of an arbitrary string token."""
    return F.conv(F.substring(F.md5(token), start, 8), 16, 10).cast("bigint")
