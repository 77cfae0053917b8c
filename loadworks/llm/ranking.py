"""Positions of rows within groups, in order, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadworks.llm.components import small, stored


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order`` within the group) and ``n`` (rows of the group).

    The rows are range-partitioned by group and order, so a group that holds most of
    them lies in many tasks; a running number first breaks ties, so rows that are
    equal in ``order`` are dealt out as well.  What a group's window sees are the
    counts of the group in each range partition.  NULLs come first and are one group.
    """
    marked = stored(rows.withColumn("__tie", F.monotonically_increasing_id()), "unsorted")
    keys = [group, *[c for c in order if c != group], "__tie"]
    line = stored(marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
                  .withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    whole = Window.partitionBy("__group")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (line.groupBy(F.col(group).alias("__group"), part.alias("__part"))
              .agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
              .select("__group", "__part", F.sum("__rows").over(whole).alias("n"),
                      (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift")))
    starts = small(stored(starts, "starts"))
    same = F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part"))
    return line.join(starts, same).select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "n")
