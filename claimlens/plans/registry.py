"""The list of registered queries and, where one exists, the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the tables in a folder. ``covers`` names inventory ids."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def six(df: DataFrame, *names: str) -> DataFrame:
    """Round doubles for comparison with another engine, whose last bits may differ."""
    return df.withColumns({n: F.round(n, 6) for n in names})
