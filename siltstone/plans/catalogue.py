"""The queries over the driver's tables, with the SQL that states what each returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its name; sql is what DuckDB runs beside it."""

    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from siltstone.plans import corpus_queries, file_queries, function_queries, operator_queries, search_queries, table_queries, taxonomy_queries, text_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["r08_hybrid"](spark, sf_dir)
