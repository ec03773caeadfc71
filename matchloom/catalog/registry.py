"""Registered queries, each next to the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchloom.catalog.base_sql import with_tables
from matchloom.session import TABLE_CONF, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: str = "") -> Callable[[Query], Query]:
    """Register a query. ``tables`` names the base relations ``sql`` refers to."""
    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark, TABLE_CONF), sf_dir.rstrip("/"))
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = tuned
        if sql is not None:
            EXPECTED[name] = with_tables(tables.split(), sql)
        return run
    return register
