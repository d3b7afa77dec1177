"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.queries import views


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, uses: str = "") -> Callable:
    """Register a query. ``uses`` names the SQL views its oracle starts from."""

    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = Query(run, views.with_views(sql, uses.split()) if sql else None)
        return run

    return add
