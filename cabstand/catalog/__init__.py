"""The operators bound to the given tables, each with the SQL that yields the same rows."""

from cabstand.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
