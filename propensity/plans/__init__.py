"""Registered queries (``QUERIES``/``ORACLES``) and the end-to-end job."""

from . import metric_queries, model_queries, profile_queries, split_queries  # noqa: F401  (register queries)
from .catalog import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
