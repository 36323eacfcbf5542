"""Named queries over the driver tables and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame``. The oracle, when given,
is plain SQL over views named like the tables and must produce the same
columns (same names) and values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from loomgraph.plans import stages
            stages.clear()
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco
