"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage. Each operator has its
own module with a general interface; ``queries.py`` holds the thin registered
queries that digest the operators' outputs."""
