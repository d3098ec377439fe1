"""Registered queries: each is ``fn(spark, sf_dir) -> DataFrame`` over the
driver tables, paired (where SQL can express it) with a DuckDB oracle."""

from tessera.plans.registry import ORACLE, QUERIES, load_all  # noqa: F401
