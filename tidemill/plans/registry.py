"""All registered queries of the engine's own operators, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

from . import adapter_queries, corpus_queries, dedup_queries, filter_queries  # noqa: E402

MODULES: list = [dedup_queries, filter_queries, corpus_queries, adapter_queries]


def queries() -> dict[str, Query]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE_SQL.items()}
