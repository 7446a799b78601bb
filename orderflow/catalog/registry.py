"""Named queries and the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.catalog.fixtures import Inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
TABLES: dict[str, str] = {}


def table(name: str, sql: str) -> None:
    """A named step that checking SQL may build on; it may build on earlier ones itself."""
    TABLES[name] = sql.strip()


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in TABLES:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(TABLES[name], found)
            found.append(name)
    return found


def with_tables(sql: str) -> str:
    """SQL preceded by the named steps it uses."""
    steps = [f"{name} as ({TABLES[name]})" for name in _needed(sql, [])]
    return (f"with {', '.join(steps)} " if steps else "") + sql.strip()


def query(name: str, check: str | None = None) -> Callable[[Callable[[Inputs], DataFrame]], Query]:
    """Registers a function of the inputs as a query, with its checking SQL if it has one."""
    def register(build: Callable[[Inputs], DataFrame]) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        run = lambda spark, folder: build(Inputs(spark, folder))
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = with_tables(check)
        return run
    return register
