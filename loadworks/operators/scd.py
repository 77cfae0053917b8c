"""Type-2 slowly changing dimensions: build, apply, as-of, current.

Dimension layout: business keys, attributes, ``valid_from``, ``valid_to``
(half-open ``[valid_from, valid_to)``; the open end is 9999-12-31) and
``is_current``.

* ``scd2_build`` turns a full history into versions: order by the effective
  time per key, drop rows whose attributes equal the previous row's (compared
  null-safely, not by a hash that could collide or equate NULL layouts),
  ``valid_to`` is the next version's ``valid_from``.
* ``scd2_apply`` applies a batch to an existing dimension and touches only the
  keys in the batch: closed versions (and rows whose flag or key is NULL) pass
  through unchanged, the current versions of batch keys are rebuilt together
  with the batch.  Batch rows not later than the key's current ``valid_from``
  are returned as *late* rows, rows with a NULL key as *rejects*.
* ``load_batch`` does the same on a stored dimension partitioned by
  ``is_current``: it adds the newly closed versions and replaces the current
  partition by one record of the load journal; files of closed versions are never
  rewritten, and a load that died is completed or undone by running it again.

Neighbour rows are found with ``sequence.with_neighbour`` on (key, day)
buckets, so a key holding a large share of the history is spread over many
tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadworks.operators.apply import any_null, null_key_rows
from loadworks.operators.sequence import bucketed, with_last, with_neighbour
from loadworks.operators.shaping import project_common, qcol
from loadworks.session import scratch_path
from loadworks.sources.journal import Change, Journal
from loadworks.sources.sinks import location

OPEN_END = "9999-12-31 00:00:00"
CURRENT = "is_current"
VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def _open_end(dtype: str) -> Column:
    return F.lit(OPEN_END).cast(dtype)


class Versions(NamedTuple):
    """Versions of a history, and its rows with a NULL key."""

    dim: DataFrame
    rejects: DataFrame


class Changes(NamedTuple):
    """What a batch does to a dimension.

    ``current``: all current versions afterwards; ``closed``: versions that the
    batch closed (or that open and close within it); ``passive``: rows the batch
    cannot touch (closed before, NULL flag or NULL key); ``late`` and
    ``rejects``: batch rows not applied.
    """

    current: DataFrame
    closed: DataFrame
    passive: DataFrame
    late: DataFrame
    rejects: DataFrame


class Applied(NamedTuple):
    """The new image of a dimension, and the batch rows that were not applied."""

    image: DataFrame
    late: DataFrame
    rejects: DataFrame


def scd2_build(history: DataFrame, keys: list[str], attrs: list[str], effective: str,
               tie_break: list[str] | None = None, bucket: str | None = "day") -> Versions:
    """Versions from a full history (one row per key and effective instant).

    ``tie_break`` columns order rows that share an effective instant; without
    them two rows of one key and instant fail the job, whatever their
    attributes.  ``bucket`` is the time slice used to split hot keys (``range``: slices
    taken from the data, for keys that are busy within any slice; ``None``: plain
    per-key window).  Rows with a NULL key come back as rejects.
    """
    rejects = null_key_rows(history, keys)
    return Versions(_versions(history.filter(~any_null(keys)), keys, attrs, effective, tie_break,
                              bucket), rejects)


def _versions(history: DataFrame, keys: list[str], attrs: list[str], effective: str,
              tie_break: list[str] | None, bucket: str | None) -> DataFrame:
    tie = list(tie_break or [])
    order = [effective] + tie
    eff_type = dict(history.dtypes)[effective]
    rows = history.select(*[qcol(c) for c in dict.fromkeys(keys + attrs + order)])
    attr_struct = F.struct(*[qcol(a) for a in attrs])
    # One bucket column for both passes: the data is shuffled once.
    rows, bcol = bucketed(rows, keys, order, bucket)

    # 1. previous row of the key (to detect changes)
    seen = F.struct(attr_struct.alias("a"), qcol(effective).alias("e"))
    with_prev = with_neighbour(rows, keys, order, seen, "__prev", "prev", bcol)
    prev = F.col("__prev").getField("v")
    changed = F.col("__prev").isNull() | ~attr_struct.eqNullSafe(prev.getField("a"))
    if not tie:
        # Two rows of one key at one instant have no defined order: fail.
        same = F.col("__prev").isNotNull() & qcol(effective).eqNullSafe(prev.getField("e"))
        changed = F.when(same, F.raise_error(F.lit("two history rows share key and instant; "
                                                   "pass tie_break")).cast("boolean")).otherwise(changed)
    versions = with_prev.filter(changed).drop("__prev")

    # 2. next version of the key (its valid_from closes this one)
    with_next = with_neighbour(versions, keys, order, qcol(effective), "__next", "next", bcol)
    nxt = F.col("__next").getField("v")
    return with_next.select(
        *[qcol(c) for c in dict.fromkeys(keys + attrs)],
        qcol(effective).alias(VALID_FROM),
        F.coalesce(nxt, _open_end(eff_type)).alias(VALID_TO),
        F.col("__next").isNull().alias(CURRENT),
        *[qcol(c) for c in tie],
    )


def scd2_changes(dim: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str],
                 effective: str, tie_break: list[str] | None = None,
                 bucket: str | None = "day") -> Changes:
    """The parts of a dimension after a batch; see ``scd2_apply`` for the rules."""
    tie = list(tie_break or [])
    eff_type = dict(dim.dtypes)[VALID_FROM]
    rejects = null_key_rows(batch, keys)
    batch = batch.filter(~any_null(keys))
    # A NULL flag is not current; a current row with a NULL key matches no batch row.
    is_current = F.coalesce(F.col(CURRENT), F.lit(False)) & ~any_null(keys)
    current = dim.filter(is_current)
    passive = dim.filter(~is_current)

    starts = current.groupBy(*[qcol(k) for k in keys]).agg(F.max(VALID_FROM).alias("__cur_from"))
    tagged = batch.join(starts, keys, "left")
    is_late = F.coalesce(qcol(effective) <= F.col("__cur_from"), F.lit(False))
    late = tagged.filter(is_late).select(*[qcol(c) for c in batch.columns])
    on_time = tagged.filter(~is_late).select(*[qcol(c) for c in batch.columns])

    hits = on_time.groupBy(*[qcol(k) for k in keys]).agg(F.lit(True).alias("__hit"))
    marked = current.join(hits, keys, "left")
    touched = marked.filter(F.col("__hit"))
    untouched = marked.filter(F.col("__hit").isNull())

    batch_types = dict(batch.dtypes)
    seed = touched.select(*[qcol(c) for c in dict.fromkeys(keys + attrs)],
                          F.col(VALID_FROM).cast(eff_type).alias(effective),
                          *[(qcol(c) if c in dim.columns else F.lit(None)).cast(batch_types[c])
                            .alias(c) for c in tie])
    history = seed.unionByName(on_time.select(
        *[qcol(c) for c in dict.fromkeys(keys + attrs + [effective] + tie)]))
    rebuilt = _versions(history, keys, attrs, effective, tie, bucket)
    cols = [qcol(c) for c in dim.columns]
    return Changes(untouched.select(*cols).unionByName(rebuilt.filter(F.col(CURRENT)).select(*cols)),
                   rebuilt.filter(~F.col(CURRENT)).select(*cols), passive, late, rejects)


def scd2_apply(dim: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str],
               effective: str, tie_break: list[str] | None = None,
               bucket: str | None = "day") -> Applied:
    """Apply a batch to a dimension; returns ``(image, late, rejects)``.

    * unchanged attributes -> the current version stays;
    * changed -> the current version closes at the batch instant, a new one opens;
    * new key -> inserted; key absent from the batch -> untouched;
    * batch row at or before the key's current ``valid_from`` -> late, not applied;
    * batch row with a NULL key -> rejected; dimension rows with a NULL flag or
      key stay as they are;
    * several batch rows for one key -> versioned among themselves first.
    """
    c = scd2_changes(dim, batch, keys, attrs, effective, tie_break, bucket)
    return Applied(c.passive.unionByName(c.current).unionByName(c.closed), c.late, c.rejects)


class Loaded(NamedTuple):
    """What a load did to a stored dimension, and the batch rows that were not applied."""

    change: Change
    late: DataFrame
    rejects: DataFrame


def load_batch(table: str, batch: DataFrame, keys: list[str], attrs: list[str], effective: str,
               tie_break: list[str] | None = None, bucket: str | None = "day", load_id: str | None = None,
               step: Callable[[str], None] = lambda name: None) -> Loaded:
    """Apply a batch to a stored dimension partitioned by ``is_current``.

    Reads the current partition only.  Closed versions are added and the current
    partition's files are replaced by one journal record (see ``sources.journal``), so
    a batch writes in proportion to the current versions, never to the history, and
    a run that dies is complete or undone when the load is run again (or
    ``Journal.finish`` is called) under the same ``load_id``; an id that has been applied
    changes nothing.  Without an id every call is a load of its own.
    """
    spark = batch.sparkSession
    journal = Journal(spark, location(spark, table), step)
    load_id = load_id or uuid.uuid4().hex
    if journal.finish():
        _refresh(spark, table)
    change = journal.applied(load_id)
    dim = spark.table(table)
    rest = scratch_path(spark, "scd2-rest")
    late, rejects = batch.limit(0), batch.limit(0)
    if change is None:
        base = journal.version()
        c = scd2_changes(dim.filter(F.col(CURRENT)), batch, keys, attrs, effective, tie_break, bucket)
        # what is not applied depends on the files that the load replaces
        c.late.write.parquet(f"{rest}/late")
        c.rejects.write.parquet(f"{rest}/rejects")
        late, rejects = (spark.read.schema(batch.schema).parquet(f"{rest}/{n}") for n in ("late", "rejects"))
        image = c.closed.unionByName(c.current).unionByName(c.passive).select(*[qcol(x) for x in dim.columns])
        change = journal.change(load_id, image, journal.folder.data_files(f"{CURRENT}=true"), [CURRENT], base)
        _refresh(spark, table)
    return Loaded(change, late, rejects)


def _refresh(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table} ADD PARTITIONS")
    spark.catalog.refreshTable(table)


def as_of(dim: DataFrame, instant) -> DataFrame:
    """Versions valid at ``instant``: ``valid_from <= t < valid_to``."""
    t = instant if isinstance(instant, Column) else F.lit(instant).cast(dict(dim.dtypes)[VALID_FROM])
    return dim.filter((F.col(VALID_FROM) <= t) & (t < F.col(VALID_TO)))


def as_of_rows(facts: DataFrame, dim: DataFrame, keys: dict[str, str], at: str, cols: list[str],
               bucket: str | None = "day") -> DataFrame:
    """Each fact with the columns ``cols`` of the version valid at its own instant ``at``.

    ``keys`` maps fact columns to key columns of the dimension.  Facts and versions are
    put into one sequence by key and time; the version in force is the last one that
    begins at or before the fact, if it has not ended.  So there is no join on a range: a
    key's facts are not multiplied by its versions, and hot keys are split by ``bucket`` (see
    ``sequence``).  Facts of an unknown or NULL key, of a NULL instant, or of one that no
    version covers get NULLs; every fact comes back once, whatever its repetitions.
    Versions of one key must not overlap.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    kind = dict(dim.dtypes)[VALID_FROM]
    own = F.struct(*[qcol(c) for c in facts.columns])
    version = F.struct(F.col(VALID_TO).alias("ends"), F.struct(*[qcol(c).alias(c) for c in cols]).alias("cols"))
    fact_type = f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in facts.schema)}>"
    begun = dim.filter(~any_null(list(keys.values()))).select(
        *[qcol(k).alias(n) for n, k in zip(names, keys.values())], F.col(VALID_FROM).alias("__t"),
        F.lit(0).alias("__kind"), version.alias("__version"), F.lit(None).cast(fact_type).alias("__fact"))
    asked = facts.select(*[qcol(k).cast(dict(dim.dtypes)[d]).alias(n) for n, (k, d) in zip(names, keys.items())],
                         qcol(at).cast(kind).alias("__t"), F.lit(1).alias("__kind"),
                         F.lit(None).cast(begun.schema["__version"].dataType).alias("__version"), own.alias("__fact"))
    line, bcol = bucketed(begun.unionByName(asked), names, ["__t", "__kind"], bucket)
    found = with_last(line, names, ["__t", "__kind"], F.col("__version"), "__last", bcol).filter("__kind = 1")
    held = F.col("__last.v")
    valid = (F.col("__t") < held["ends"]) & F.col("__t").isNotNull() & ~any_null(names)
    return found.select("__fact.*", *[F.when(valid, held["cols"][c]).alias(c) for c in cols])


def current(dim: DataFrame, target_cols: list[str] | None = None) -> DataFrame:
    """The latest image (one row per key), optionally shaped to a target."""
    cur = dim.filter(F.col(CURRENT))
    return project_common(cur, target_cols) if target_cols else cur


def version_gaps(dim: DataFrame, keys: list[str], bucket: str | None = "day") -> DataFrame:
    """Versions whose end date differs from the next version's start date (NULL keys included)."""
    staged, bcol = bucketed(dim, keys, [VALID_FROM], bucket)
    nxt = with_neighbour(staged, keys, [VALID_FROM], F.col(VALID_FROM), "__next", "next", bcol)
    nv = F.col("__next").getField("v")
    return nxt.filter(nv.isNotNull() & (F.col(VALID_TO).cast("date") != nv.cast("date"))) \
        .select(*[qcol(k) for k in keys], VALID_FROM, VALID_TO, nv.alias("next_valid_from"))
