"""Registry of named queries over the driver's tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and runs a library job over
whole tables (or data Spark derives from them). ``oracle`` is the equivalent
DuckDB SQL over the same tables, with identical column names; queries that SQL
cannot express (stateful streaming is expressed, model training is not) carry
none and are checked against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco
