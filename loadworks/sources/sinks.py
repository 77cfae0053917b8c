"""Table sinks: publish (swap), append with retry, partition overwrite, DDL.

``publish`` writes the new image to a staging table of its own name and then
swaps names: the old table is renamed to a backup, the new one takes its name,
and only then is the backup dropped.  The image may be computed *from* the
table it replaces, writers do not share a staging table, and a swap that fails
puts the old table back.  The swap is two catalog operations and not atomic: a
reader between them sees no table.

``publish_version`` has no such gap: every image is a folder of its own, and the
name is a view that is pointed to the next folder by one catalog operation.
Readers that have begun keep the folder they resolved.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadworks.operators.shaping import qcol
from loadworks.sources.folders import Folder
from loadworks.sources.journal import WRITE_SALT, Conflict

# Fixed value: what a concurrent append is called in the error of a table format.
CONCURRENT_APPEND = "ConcurrentAppend"
KEPT_VERSIONS = 3  # published versions that stay for readers


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _partitioned_writer(df: DataFrame, partition_by: list[str] | None):
    """Rows of a partition go to few tasks: by the partition columns and a salt that
    spreads a large partition, instead of a file a task and partition."""
    if not partition_by:
        return df.write.format("parquet")
    salt = F.pmod(F.xxhash64(*[qcol(c) for c in df.columns if c not in partition_by]), F.lit(WRITE_SALT))
    return df.repartition(*[qcol(c) for c in partition_by], salt).write.format("parquet")


def publish(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace ``table`` with the image ``df`` (write new, set old aside, rename, drop old)."""
    spark = _spark(df)
    tag = uuid.uuid4().hex[:8]
    staging, backup = f"{table}__new_{tag}", f"{table}__old_{tag}"
    writer = _partitioned_writer(df, partition_by).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(staging)
    had = table_exists(spark, table)
    if had:
        _rename(spark, table, backup)
    try:
        _rename(spark, staging, table)
    except Exception:
        if had:
            _rename(spark, backup, table)
        raise
    if had:
        spark.sql(f"DROP TABLE {backup}")
    return spark.table(table)


def _versions(spark: SparkSession, name: str) -> Folder:
    """The folder of a name's versions, beside the tables of its database."""
    database, _, view = name.rpartition(".")
    info = spark.catalog.getDatabase(database or spark.catalog.currentDatabase())
    return Folder(spark, f"{info.locationUri.rstrip('/')}/{view}__versions")


def publish_version(df: DataFrame, name: str, partition_by: list[str] | None = None,
                    keep: int = KEPT_VERSIONS) -> DataFrame:
    """Replace what ``name`` shows with the image ``df``, without a moment in which it shows nothing.

    The image is written to a folder of its own; then the view is pointed to it.  A
    writer that dies before that leaves a folder that nobody reads, and the next
    publication drops it.  The last ``keep`` versions stay, so a reader has the time of
    so many publications to finish; publishers of one name take turns.
    """
    spark = _spark(df)
    folder = _versions(spark, name)
    shown = published_version(spark, name)
    number = max([shown or 0, *(int(n[1:9]) for n in folder.names())]) + 1
    path = folder.child(f"v{number:08d}-{uuid.uuid4().hex[:8]}")
    writer = _partitioned_writer(df, partition_by)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    select = f"SELECT * FROM parquet.`{path}`"
    # ALTER VIEW changes the entry in one step; CREATE OR REPLACE would drop it first
    spark.sql(f"ALTER VIEW {name} AS {select}" if shown is not None else f"CREATE VIEW {name} AS {select}")
    done = [n for n in folder.names() if int(n[1:9]) <= number]
    for old in done[:-keep]:
        folder.delete(old)
    return spark.table(name)


def published_path(spark: SparkSession, name: str) -> str | None:
    """The folder that a published name shows; None if nothing is published."""
    if not table_exists(spark, name):
        return None
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'")
    return info.first()["data_type"].split("`")[1]


def published_version(spark: SparkSession, name: str) -> int | None:
    """The number of the version that a published name shows."""
    path = published_path(spark, name)
    return int(path.rpartition("/")[2][1:9]) if path else None


def pinned(spark: SparkSession, name: str) -> DataFrame:
    """The version that a published name shows now, whatever is published later."""
    return spark.read.parquet(published_path(spark, name))


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table; the catalog keeps partition locations, so they are found again."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if any(c.isPartition for c in spark.catalog.listColumns(new)):
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def is_concurrent_append(error: Exception) -> bool:
    """Did another writer's commit get in between?"""
    return isinstance(error, Conflict) or CONCURRENT_APPEND in str(error)


def append_with_retry(df: DataFrame, table: str,
                      is_conflict: Callable[[Exception], bool] = is_concurrent_append,
                      attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> int:
    """Append to a shared table, retrying concurrent-append conflicts.

    Up to ``attempts`` tries with a back-off of 2, 4, 6, ... seconds; any other
    error is raised at once.  Returns the number of the successful attempt.  An append
    whose answer was lost must not be repeated this way: see ``journal.append_once``.
    """
    for n in range(attempts):
        try:
            df.write.mode("append").format("parquet").saveAsTable(table)
            return n + 1
        except Exception as exc:  # noqa: BLE001 - re-raised unless a conflict
            if not is_conflict(exc) or n == attempts - 1:
                raise
            sleep(2 * (n + 1))
    raise RuntimeError("unreachable")


def location(spark: SparkSession, table: str) -> str:
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return info.first()["data_type"]


def insert_partitions(df: DataFrame, table: str) -> None:
    """``INSERT OVERWRITE table PARTITION (...) SELECT ...`` in dynamic mode:
    only partitions present in ``df`` are replaced.

    The mode is an option of this write (``insertInto`` would take it from the
    session's configuration, which other loads share), so the files are written
    to the table's folder and new partitions are then added to the catalog.
    """
    spark = _spark(df)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    rows = df.select(*[qcol(c) for c in spark.table(table).columns])
    if not parts:
        rows.write.insertInto(table, overwrite=True)
        return
    _partitioned_writer(rows, parts).option("partitionOverwriteMode", "dynamic") \
        .mode("overwrite").partitionBy(*parts).save(location(spark, table))
    spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
    spark.catalog.refreshTable(table)


def clone_empty(df: DataFrame, extra_cols: dict[str, str] | None = None) -> DataFrame:
    """An empty frame with the columns of ``df`` plus typed NULL extras."""
    extra = extra_cols or {}
    return df.limit(0).select("*", *[F.lit(None).cast(t).alias(n) for n, t in extra.items()])


def first_readable(spark: SparkSession, candidates: list[str]) -> tuple[str, DataFrame]:
    """The first of several tables that there is and that can be read, with its name.

    Reading is tried on the schema and one row's worth of files; a table that is listed
    but whose files are gone is passed over.
    """
    for name in candidates:
        try:
            df = spark.table(name)
            df.limit(1).count()
            return name, df
        except Exception:  # noqa: BLE001 - the next candidate may do
            continue
    raise ValueError(f"none of {', '.join(candidates)} can be read")


def create_clone_of_first(spark: SparkSession, candidates: list[str], table: str,
                          extra_cols: dict[str, str] | None = None,
                          partition_by: list[str] | None = None) -> str:
    """``create_clone`` of the first readable candidate; returns its name."""
    name, df = first_readable(spark, candidates)
    create_clone(df, table, extra_cols, partition_by)
    return name


def create_clone(df: DataFrame, table: str, extra_cols: dict[str, str] | None = None,
                 partition_by: list[str] | None = None) -> None:
    """Create an empty table shaped like ``df`` (plus extras), partitioned."""
    writer = clone_empty(df, extra_cols).write.mode("ignore").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def ensure_table(spark: SparkSession, name: str, schema: StructType,
                 partition_by: list[str] | None = None,
                 comments: dict[str, str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with declared types, comments, partitions."""
    comments = comments or {}
    parts = partition_by or []
    cols = []
    for f in schema.fields:
        text = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in comments:
            text += " COMMENT '" + comments[f.name].replace("'", "\\'") + "'"
        cols.append(text)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet"
    if parts:
        sql += " PARTITIONED BY (" + ", ".join(f"`{p}`" for p in parts) + ")"
    spark.sql(sql)


def ensure_view(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS select_sql``; returns the view."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")
    return spark.table(name)


def empty_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    """An empty all-STRING frame from a column list (last-resort stub)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return spark.createDataFrame([], schema)


def column_inventory(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, data_type, non_nulls)`` of a table, one scan."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(qcol(f.name)).alias(f"__c{i}") for i, f in enumerate(fields)])
    entries = [F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"__c{i}").alias("non_nulls"))
               for i, f in enumerate(fields)]
    return counts.select(F.inline(F.array(*entries)))
