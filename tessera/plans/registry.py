"""Query registry shared by ``__spark_entry__`` and the tests."""

from __future__ import annotations

import importlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
KIND: dict[str, str] = {}

MODULES = ["classify", "q_sources", "q_columns", "q_relational", "q_metrics", "q_ordering", "q_transforms",
           "q_targets", "q_views", "q_ragged", "q_work", "q_telemetry", "q_streaming", "q_surface"]


def register(key: str, sql: str | None = None, kind: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        KIND[key] = kind or ("O" if sql is not None else "R")
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        try:
            importlib.import_module(f"tessera.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.plans.{m}":
                raise
