"""Every query of the library proper, with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakesieve.plans import operations, parsing, records, relational

MODULES = [parsing, relational, operations, records]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}
