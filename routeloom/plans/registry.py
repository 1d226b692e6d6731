"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from routeloom.plans import (
    graph_queries,
    model_queries,
    network_queries,
    statistic_queries,
    table_queries,
)

_MODULES = (graph_queries, network_queries, table_queries, statistic_queries, model_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in module.SQL.items()}
