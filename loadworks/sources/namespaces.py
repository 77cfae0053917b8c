"""Reading tables of a source and a target namespace by their short names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Namespaces:
    """A session with the schemas it loads from and into (``schema`` or ``catalog.schema``)."""

    spark: SparkSession
    source: str
    target: str

    def read_source(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.source}.{table}")

    def read_target(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.target}.{table}")

    def first_readable(self, *candidates: str) -> DataFrame:
        """The first of some fully named tables that exists."""
        for name in candidates:
            if self.spark.catalog.tableExists(name):
                return self.spark.table(name)
        raise LookupError(f"none of {', '.join(candidates)} exists")
