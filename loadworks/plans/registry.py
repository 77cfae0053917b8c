"""Registry of named queries and their SQL oracles.

A recipe is a function ``(spark, sf_dir) -> DataFrame`` that reads the test
tables and runs one operator of the library over them.  Its oracle, when the
semantics are SQL-expressible, is an independent DuckDB query over the same
Parquet tables with identical output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Recipe = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Recipe] = {}
ORACLE: dict[str, str] = {}


def recipe(name: str, oracle: str | None = None):
    """Register a query under ``name`` with an optional oracle SQL string."""
    def deco(fn: Recipe) -> Recipe:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]
