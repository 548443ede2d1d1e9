"""Registered queries: each operator on the test tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.files import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must agree."""
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dealt(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for per-row work, dealt out over the cores."""
    return spread(table(spark, folder, name))


def load() -> None:
    """Import all query modules."""
    from tidewell.queries import (  # noqa: F401
        codes, enrichment, files, matching, normalising, star, trials, upserts,
    )
