"""Collects queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def add(name: str, run: Query, check: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    QUERIES[name] = run
    if check is not None:
        CHECKS[name] = " ".join(check.split())


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def keep(run: Query) -> Query:
        add(name, run, check)
        return run

    return keep
