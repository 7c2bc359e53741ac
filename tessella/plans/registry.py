"""All registered queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from tessella.plans import cohorts, panels, reports, studies  # noqa: F401  they register theirs

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)
