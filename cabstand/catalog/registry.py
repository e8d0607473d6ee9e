"""Collects the bound queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("scans", "rows", "rollups", "scalars", "checks", "flows", "lifecycle")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a bound query, with its SQL where SQL can say it."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        run.__name__, run.__doc__ = name, function.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return function

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"cabstand.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
