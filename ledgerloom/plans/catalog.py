"""Registry of the library's queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES: tuple[str, ...] = ("ledger_plans", "audit_plans", "text_plans", "provider_plans", "nested_plans", "evidence_plans")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for name in MODULES:
        module = importlib.import_module(f"ledgerloom.plans.{name}")
        for key, (run, sql) in module.QUERIES.items():
            if key in queries:
                raise ValueError(f"query {key} is registered twice")
            queries[key] = run
            if sql is not None:
                oracles[key] = sql
    return queries, oracles
