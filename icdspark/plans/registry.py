"""Query registry: name -> (spark builder, DuckDB oracle SQL or None).

Every registered query reads the given Parquet tables (through the proxy views)
and runs over whole tables; nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

_MODULES = (
    "icdspark.plans.q_cohort",
    "icdspark.plans.q_split",
    "icdspark.plans.q_metrics",
    "icdspark.plans.q_features",
    "icdspark.plans.q_model",
    "icdspark.plans.q_sources",
)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    for m in _MODULES:
        importlib.import_module(m)
    return REGISTRY


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in load_all().items() if v[1] is not None}
