"""Collects every registered query with its reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Name to (query, SQL or None, inventory ids)."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}
        self.ids: dict[str, str] = {}

    def add(self, name: str, ids: str, sql: str | None = None):
        def wrap(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = fn
            self.ids[name] = ids
            if sql is not None:
                self.sql[name] = sql
            return fn

        return wrap


REGISTRY = Registry()


def load() -> Registry:
    from . import articles, breakdowns, expressions, layouts, series, stores, streams  # noqa: F401

    return REGISTRY
