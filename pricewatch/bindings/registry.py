"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewatch.bindings.roles import Roles, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(roles) -> DataFrame`` under a name, with the SQL it must equal."""

    def register(build: Callable[[Roles], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Roles(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def oracle_texts() -> dict[str, str]:
    return {name: with_roles(sql) for name, sql in _SQL.items()}
