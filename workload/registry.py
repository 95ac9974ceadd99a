"""Queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.session import configure
from workload.standins import Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return run

    return register
