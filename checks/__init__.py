"""Queries over the driver tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Tables, with_views
from gladwire.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query on ``Tables`` and the SQL for the same rows."""

    def add(query: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(Tables(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return query

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from checks import (  # noqa: F401
        aggregates, dedup, enrichment, feeds, functions, pages, scoring, sinks, stores,
    )
