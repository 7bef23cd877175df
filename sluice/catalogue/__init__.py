"""Queries over the given tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.catalogue import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Registers a query; ``uses`` names the views its SQL reads."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = views.with_views(sql, uses)
        return fn
    return register


def load() -> tuple[dict, dict]:
    from sluice.catalogue import (columns, dictionaries, linkage, personal, reasons, rows,  # noqa: F401
                                  shapes)
    return dict(QUERIES), dict(ORACLES)
