"""Queries of this package: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ["token_counts", "near_dedup", "exact_dedup", "toxicity", "mixing", "decontaminate", "pii", "token_files", "quality", "line_dedup",
           "repair", "chat", "spelling"]


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tessera.llm.{m}")
