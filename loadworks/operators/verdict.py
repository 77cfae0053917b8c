"""Building blocks for check results ``(check_name, status, detail, measure)``.

A suite computes all its measures in one aggregate per table (a single row),
then turns that row into one output row per check with ``inline`` — no
action runs until the caller asks for the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURE_TYPE = "decimal(20,2)"
RESULT_COLUMNS = ["check_name", "status", "detail", "measure"]


def as_text(c: Column) -> Column:
    return c.cast("string")


def percent(num: Column, den: Column) -> Column:
    """``num / den * 100`` rounded half up to two places, exact; 0 when den is 0.

    Integer arithmetic, so both engines of the oracle test agree to the cent.
    """
    hundredths = F.when(den > 0, int_div(num * 20000 + den, den * 2)).otherwise(F.lit(0))
    return (hundredths / F.lit(100)).cast(MEASURE_TYPE)


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of two integral columns."""
    return F.floor(a.cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def check(name, status: Column, detail: Column | None = None,
          measure: Column | None = None) -> Column:
    """One check row as a struct; ``name`` may be a string or a Column."""
    n = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        n.cast("string").alias("check_name"),
        status.cast("string").alias("status"),
        (detail if detail is not None else F.lit(None)).cast("string").alias("detail"),
        (measure if measure is not None else F.lit(None)).cast(MEASURE_TYPE).alias("measure"),
    )


def rows(one_row: DataFrame, checks: list[Column]) -> DataFrame:
    """Explode a single-row metrics frame into check rows."""
    return one_row.select(F.inline(F.array(*checks)))


def combine_metrics(*frames: DataFrame) -> DataFrame:
    """Merge several one-row aggregates into one row without a join.

    Each frame must carry distinct column names; they are stacked with
    ``unionByName(allowMissingColumns=True)`` and folded with ``max``.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(f.columns)
    return stacked.agg(*[F.max(F.col(c)).alias(c) for c in cols])
