"""Row-level changes of a stored table that rewrite only the files they touch.

``apply.py`` gives the whole new image of a target.  Here the target is a folder
of Parquet files: a first pass reads the key columns only, pruned by the least and
greatest key of the batch (pushed down to the files' statistics), and finds the
files that hold a key of the batch.  Only these are read in full, changed with the
operators of ``apply.py`` and replaced through the load journal; all other files
keep their names and contents.  Files sorted or partitioned by key make the
touched share small.

The batch is stored once, as it is read several times.  The driver holds the names
of the touched files, as Spark's file index does.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadworks.operators import apply as A
from loadworks.operators.shaping import project_to, qcol
from loadworks.session import scratch
from loadworks.sources.journal import Change, Journal


class Rewritten(NamedTuple):
    """The journal's change, and how many files the table had before."""

    change: Change
    files: int


def key_range(batch: DataFrame, keys: list[str]) -> Column | None:
    """A condition that every row with a key of the batch meets; None if the batch has no key."""
    ends = batch.agg(*[f(qcol(k)).alias(f"{n}{i}") for i, k in enumerate(keys)
                       for n, f in (("a", F.min), ("b", F.max))]).first()
    if any(v is None for v in ends):
        return None
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & qcol(k).between(F.lit(ends[f"a{i}"]), F.lit(ends[f"b{i}"]))
    return cond


def _hash(address: Column) -> Column:
    """Hash of a file's address without its scheme, which Spark writes in several ways."""
    return F.xxhash64(F.regexp_replace(address, "^[A-Za-z0-9+.-]+:/+", "/"))


def _named(table: DataFrame, hashes: list[int]) -> list[str]:
    """Addresses of the table's files by the hash of their address."""
    spark, paths = table.sparkSession, table.inputFiles()
    if not hashes or not paths:
        return []
    listed = spark.createDataFrame([(p,) for p in paths], "file string")
    wanted = set(hashes)
    return [r["file"] for r in listed.withColumn("h", _hash(F.col("file"))).collect() if r["h"] in wanted]


def files_with_keys(table: DataFrame, batch: DataFrame, keys: list[str]) -> list[str]:
    """Addresses of the table's files that hold a key of the batch (NULL keys match nothing)."""
    pruned = key_range(batch, keys)
    if pruned is None:
        return []
    rows = table.select(*[qcol(k) for k in keys], F.col("_metadata.file_path").alias("__file")).filter(pruned)
    hit = rows.withColumn("__file", _hash(F.col("__file"))) \
        .join(batch.select(*[qcol(k) for k in keys]), keys, "left_semi")
    return _named(table, [r["__file"] for r in hit.select("__file").distinct().collect()])


def files_with_rows(table: DataFrame, predicate: Column) -> list[str]:
    """Addresses of the table's files that hold a row meeting the predicate."""
    hit = table.filter(predicate).select(_hash(F.col("_metadata.file_path")).alias("__file")).distinct()
    return _named(table, [r["__file"] for r in hit.collect()])


def _plain(path: str) -> str:
    """A path whose characters mean themselves in a read."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def _rewrite(spark: SparkSession, path: str, find: Callable[[DataFrame], list[str]],
             change: Callable[[DataFrame], DataFrame], partition_by: list[str] | None,
             load_id: str | None, step: Callable[[str], None]) -> Rewritten:
    journal = Journal(spark, path, step)
    load_id = load_id or uuid.uuid4().hex
    journal.finish()
    table = spark.read.parquet(path)
    before = journal.applied(load_id)
    if before is not None:
        return Rewritten(before, len(table.inputFiles()))
    base = journal.version()
    names = [journal.folder.relative(f) for f in find(table)]
    if names:
        old = spark.read.schema(table.schema).option("basePath", _plain(path)).parquet(
            *[_plain(journal.folder.child(n)) for n in names])
    else:
        old = table.limit(0)
    image = project_to(change(old), table.columns)
    return Rewritten(journal.change(load_id, image, names, partition_by, base), len(table.inputFiles()))


def _stored(batch: DataFrame, path: str) -> DataFrame:
    batch.write.parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def _nothing(name: str) -> None:
    """No step hook."""


def upsert_files(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                 order_by: list[str] | None = None, partition_by: list[str] | None = None,
                 load_id: str | None = None, step: Callable[[str], None] = _nothing) -> Rewritten:
    """``apply.upsert`` on a stored table: files without a key of the batch stay as they are.

    New keys go to new files.  Rows of the batch with a NULL key are not applied
    (see ``apply.null_key_rows``).
    """
    with scratch(spark, "batch") as at:
        rows = _stored(batch.filter(~A.any_null(keys)), at)
        return _rewrite(spark, path, lambda t: files_with_keys(t, rows, keys),
                        lambda old: A.upsert(old, rows, keys, order_by).image, partition_by, load_id, step)


def update_files(spark: SparkSession, path: str, source: DataFrame, keys: list[str], set_cols: dict[str, str],
                 partition_by: list[str] | None = None, load_id: str | None = None,
                 step: Callable[[str], None] = _nothing) -> Rewritten:
    """``apply.update_from`` on a stored table."""
    with scratch(spark, "batch") as at:
        rows = _stored(source, at)
        return _rewrite(spark, path, lambda t: files_with_keys(t, rows, keys),
                        lambda old: A.update_from(old, rows, keys, set_cols), partition_by, load_id, step)


def delete_files(spark: SparkSession, path: str, keys_df: DataFrame, keys: list[str],
                 partition_by: list[str] | None = None, load_id: str | None = None,
                 step: Callable[[str], None] = _nothing) -> Rewritten:
    """``apply.delete_matching`` on a stored table."""
    with scratch(spark, "batch") as at:
        rows = _stored(keys_df.select(*[qcol(k) for k in keys]), at)
        return _rewrite(spark, path, lambda t: files_with_keys(t, rows, keys),
                        lambda old: A.delete_matching(old, rows, keys), partition_by, load_id, step)


def replace_files(spark: SparkSession, path: str, new: DataFrame, predicate: Column,
                  partition_by: list[str] | None = None, load_id: str | None = None,
                  step: Callable[[str], None] = _nothing) -> Rewritten:
    """``apply.replace_where`` on a stored table: an idempotent reload of the rows meeting a predicate."""
    with scratch(spark, "batch") as at:
        rows = _stored(new, at)
        return _rewrite(spark, path, lambda t: files_with_rows(t, predicate),
                        lambda old: A.replace_where(old, rows, predicate), partition_by, load_id, step)
