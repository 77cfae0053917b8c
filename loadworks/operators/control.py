"""Control totals and the control-record ``UNION ALL`` detail layout.

Landing tables carry, per group, one *control* row (data columns NULL, record
count and amount total filled) followed by the *detail* rows (real columns,
totals 0).  ``split_control_detail`` takes the layout apart again and checks
that the detail rows add up to the control row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.functions.scalar import if_not_null
from loadworks.operators.shaping import qcol

AMOUNT_TYPE = "decimal(18,2)"


def control_totals(df: DataFrame, group_cols: list[str], amount_col: str) -> DataFrame:
    """Record count and exact decimal amount total per group."""
    return df.groupBy(*[qcol(c) for c in group_cols]).agg(
        F.count(F.lit(1)).alias("ttl_rec"),
        F.sum(qcol(amount_col).cast(AMOUNT_TYPE)).alias("ttl_amt"))


def union_control_detail(df: DataFrame, group_cols: list[str], data_cols: list[str],
                         amount_col: str) -> DataFrame:
    """Control rows (NULL data, totals) ``UNION ALL`` detail rows (totals 0)."""
    types = dict(df.dtypes)
    totals = control_totals(df, group_cols, amount_col)
    control = totals.select(*[qcol(c) for c in group_cols],
                            *[F.lit(None).cast(types[c]).alias(c) for c in data_cols],
                            F.col("ttl_rec"), F.col("ttl_amt").cast("decimal(28,2)").alias("ttl_amt"))
    detail = df.select(*[qcol(c) for c in group_cols], *[qcol(c) for c in data_cols],
                       F.lit(0).cast("long").alias("ttl_rec"),
                       F.lit(0).cast("decimal(28,2)").alias("ttl_amt"))
    return control.unionByName(detail)


def split_control_detail(df: DataFrame, group_cols: list[str], marker_col: str,
                         amount_col: str) -> tuple[DataFrame, DataFrame]:
    """Split on the marker column (NULL -> control row); totals default to 0."""
    control = df.filter(qcol(marker_col).isNull()).select(
        *[qcol(c) for c in group_cols],
        if_not_null("ttl_rec", F.lit(0)).cast("long").alias("ttl_rec"),
        if_not_null("ttl_amt", F.lit(0)).cast("decimal(28,2)").alias("ttl_amt"))
    detail = df.filter(qcol(marker_col).isNotNull()).drop("ttl_rec", "ttl_amt")
    return control, detail


def reconcile_control(control: DataFrame, detail: DataFrame, group_cols: list[str],
                      amount_col: str) -> DataFrame:
    """Per group: control totals against the detail rows' own totals."""
    det = control_totals(detail, group_cols, amount_col) \
        .select(*[qcol(c) for c in group_cols], F.col("ttl_rec").alias("detail_rec"),
                F.col("ttl_amt").cast("decimal(28,2)").alias("detail_amt"))
    ctl = control.select(*[qcol(c) for c in group_cols], F.col("ttl_rec").alias("control_rec"),
                         F.col("ttl_amt").alias("control_amt"))
    j = ctl.join(det, group_cols, "full_outer")
    ok = (F.col("control_rec") == F.col("detail_rec")) & (F.col("control_amt") == F.col("detail_amt"))
    return j.select(*[qcol(c) for c in group_cols], "control_rec", "detail_rec", "control_amt",
                    "detail_amt", F.when(F.coalesce(ok, F.lit(False)), "PASS")
                    .otherwise("FAIL").alias("status"))
