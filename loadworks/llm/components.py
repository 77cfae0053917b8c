"""Stored intermediate tables and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.session import scratch_path

BROADCAST_ROWS = 300_000  # rows of two or three numbers that may be broadcast: at most about 10 MB


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts the lineage and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored side of a few numeric columns, marked for broadcast if it has few rows."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of every vertex of ``edges`` (a, b): label is the smallest vertex reachable.

    Alternating large-star and small-star steps: every vertex hands its
    neighbours on to its smallest neighbour, until only stars are left.  The
    minimum of a vertex is pre-aggregated before the shuffle; links are joined
    with it by vertex and never gathered, but all links of a hub (two numbers
    each) pass through the task of its id.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(both.where("b > a").join(least, "a")
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))  # here b < a always
        tied = large.join(least, "a")
        small_star = stored(tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        # done when every vertex has one link and no root is linked on
        moved = small_star.join(small_star.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        more = small_star.groupBy("a").count().where("count > 1")
        links = small_star
        if not moved.limit(1).count() and not more.limit(1).count():
            break
    return stored(links.select(F.col("a").alias("v"), F.col("b").alias("label"))
                  .unionByName(links.select(F.col("b").alias("v"), F.col("b").alias("label")).distinct()),
                  "components")
