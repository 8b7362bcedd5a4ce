"""Names, Spark builders and oracle texts of all registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.oracle_text import with_views

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Builder, sql: str | None = None, **views: str) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = with_views(sql, **views)
