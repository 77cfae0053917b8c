"""Previous / next row within a key, safe for hot keys.

A plain ``lag``/``lead`` window partitioned by the key puts every row of a key
into one task; a key that holds a third of the data then becomes a single
straggler task.  Here the window is partitioned by ``(key, bucket)``, where the
bucket is a coarse slice of the ordering column (a day, a month, ...), so a
hot key is spread over many tasks.

The neighbour of the first (or last) row of a bucket lies in an earlier (or
later) bucket of the same key.  The window marks each bucket's last (or first)
row; those edge rows -- one per bucket, tiny next to the data -- are ordered by
bucket within the key to find the neighbouring bucket's edge value, which is
joined back.  Windows and join use one column, a struct of the key columns and
the slice: a struct is never NULL itself, so NULL keys and NULL order values
keep their neighbours, and the big side keeps its partitioning: callers that
add the column once and chain several passes shuffle the data a single time.

Slices of the ordering column do not help a key that is busy within one slice.
``add_range_bucket`` takes slices from the data instead: rows are range-partitioned
by key and order, and the slice is the number of the range, so that all slices
are of about the same size whatever the keys; it costs one more shuffle and a
stored copy.  ``bucketed`` chooses by name.

With ``bucket_col=None`` the plain per-key window is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadworks.operators.shaping import qcol
from loadworks.session import scratch_path

BUCKET = "__bucket"
RANGE = "range"  # the name of slices taken from the data


def time_bucket(col: str, unit: str = "day") -> Column:
    """Coarse slice of a date/timestamp column used to split hot keys."""
    return F.date_trunc(unit, qcol(col))


def add_bucket(df: DataFrame, keys: list[str], bucket: Column | None) -> tuple[DataFrame, str | None]:
    """Add the bucket column (keys and slice) once; pass its name to ``with_neighbour``."""
    if bucket is None:
        return df, None
    return df.withColumn(BUCKET, F.struct(F.struct(*[qcol(k) for k in keys]).alias("key"),
                                          bucket.alias("slice"))), BUCKET


def add_range_bucket(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, str]:
    """Add a bucket column whose slices are ranges of (key, order) of about equal size.

    The ranges come from a sample, so the rows are stored with their range: all passes see
    the same one, and a task that is run again as well.  NULLs sort first, as in windows.
    """
    cols = list(dict.fromkeys([*keys, *order]))
    ranged = df.repartitionByRange(*[qcol(c) for c in cols]).withColumn("__slice", F.spark_partition_id())
    path = scratch_path(df.sparkSession, "ranges")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    return ranged.select("*", F.struct(F.struct(*[qcol(k) for k in keys]).alias("key"),
                                       F.col("__slice").alias("slice")).alias(BUCKET)).drop("__slice"), BUCKET


def bucketed(df: DataFrame, keys: list[str], order: list[str], bucket: str | None) -> tuple[DataFrame, str | None]:
    """Add the bucket column: slices of time (``day``, ``hour``, ...) of the first order column,
    ``range`` for slices taken from the data, None for none."""
    if bucket == RANGE:
        return add_range_bucket(df, keys, order)
    return add_bucket(df, keys, time_bucket(order[0], bucket) if bucket else None)


def with_last(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str,
              bucket_col: str | None = None) -> DataFrame:
    """Add ``name`` = ``struct(v)`` of the last non-NULL ``value`` up to the row within its key (its own included).

    NULL means that there is none.  The last value of each bucket is carried on to the buckets
    behind it; only these are ordered by key, one row a bucket.
    """
    v = F.when(value.isNotNull(), F.struct(value.alias("v")))
    order_cols = [qcol(c) for c in order]
    if bucket_col is None:
        w = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(*order_cols) \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.last(v, ignorenulls=True).over(w))
    w_b = Window.partitionBy(bucket_col).orderBy(*order_cols)
    upto = w_b.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = df.select("*", F.last(v, ignorenulls=True).over(upto).alias("__in"),
                      F.lead(F.lit(1)).over(w_b).isNull().alias("__edge"))
    w_k = Window.partitionBy(F.col(bucket_col).getField("key")).orderBy(F.col(bucket_col).getField("slice")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = inner.filter("__edge").select(bucket_col, F.last("__in", ignorenulls=True).over(w_k).alias("__carry"))
    return inner.join(carry, bucket_col, "left").select(*[qcol(c) for c in df.columns],
                                                        F.coalesce("__in", "__carry").alias(name))


def with_neighbour(df: DataFrame, keys: list[str], order: list[str], value: Column,
                   name: str, direction: str = "prev",
                   bucket_col: str | None = None) -> DataFrame:
    """Add ``name`` = ``struct(v)`` of the previous/next row's ``value`` within the key.

    NULL means there is no such row (a neighbour whose value is NULL still
    gives a non-NULL struct); read the value with ``.getField('v')``.
    ``order`` must be unique within a key.
    """
    v = F.struct(value.alias("v"))
    key_cols = [qcol(k) for k in keys]
    order_cols = [qcol(c) for c in order]
    step = F.lag if direction == "prev" else F.lead
    if bucket_col is None:
        w = Window.partitionBy(*key_cols).orderBy(*order_cols)
        return df.withColumn(name, step(v).over(w))

    w_b = Window.partitionBy(bucket_col).orderBy(*order_cols)
    inner = df.select("*", step(v).over(w_b).alias("__in"),
                      # the edge row whose value the neighbouring bucket needs
                      (F.lead if direction == "prev" else F.lag)(F.lit(1)).over(w_b)
                      .isNull().alias("__edge"),
                      v.alias("__v"))
    w_k = Window.partitionBy(F.col(bucket_col).getField("key")).orderBy(F.col(bucket_col).getField("slice"))
    carry = inner.filter(F.col("__edge")).select(bucket_col, step("__v").over(w_k).alias("__carry"))
    joined = inner.join(carry, bucket_col, "left")
    return joined.select(*[qcol(c) for c in df.columns],
                         F.coalesce(F.col("__in"), F.col("__carry")).alias(name))
