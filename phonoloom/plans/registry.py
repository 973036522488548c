"""Queries by name, each beside the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self._queries: dict[str, Query] = {}
        self._sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(f: Query) -> Query:
            self._queries[f.__name__] = f
            if sql is not None:
                self._sql[f.__name__] = sql
            return f

        return register

    def queries(self) -> dict[str, Query]:
        return dict(self._queries)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
