"""All queries of the core, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import data_queries, rule_queries

_PARTS = (rule_queries, data_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for part in _PARTS for name, f in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for part in _PARTS for name, text in part.oracle_sql().items()}
