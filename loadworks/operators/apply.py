"""Row-level changes as image transforms: upsert, update-from, delete, reload.

Parquet tables have no row-level DML, so each operator returns the *new image*
of the target as a DataFrame; ``loadworks.sources.sinks.publish`` swaps it in.

Scale notes
-----------
* Per-key reductions (``latest_per_key``) are ``max`` aggregates, not a
   ``row_number`` window: partial aggregation collapses each key inside each
  map task before the shuffle, so a key holding a third of all rows never
  lands whole in one task.
* Anti and semi joins against batch keys let the planner broadcast the key
  set when it is small (size-checked by the planner and by AQE) and fall back
  to a shuffle join otherwise.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadworks.operators.shaping import project_to, qcol


def any_null(keys: list[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | qcol(k).isNull()
    return cond


def null_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that no key join can ever match (route them to a reject output)."""
    return df.filter(any_null(keys))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keep the row with the greatest ``order_by`` tuple for each key.

    Remaining ties are broken by the rest of the row, so the result does not
    depend on input order.  The row is held once, as the ranked struct itself.
    """
    others = [c for c in df.columns if c not in keys and c not in order_by]
    rank = F.struct(*[qcol(c) for c in order_by + others])
    agg = df.groupBy(*[qcol(k) for k in keys]).agg(F.max(rank).alias("__row"))
    return agg.select(*[qcol(c) if c in keys else F.col("__row").getField(c).alias(c)
                        for c in df.columns])


def unique_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail the job (lazily) if a key occurs more than once, as MERGE would."""
    cols = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*[qcol(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(qcol(c)).alias(c) for c in cols])
    guard = F.when(F.col("__n") > 1,
                   F.raise_error(F.lit("several rows share one key where one is allowed")))
    return agg.select("*", guard.alias("__guard")).filter(F.col("__guard").isNull()) \
        .select(*[qcol(c) for c in df.columns])


class Upserted(NamedTuple):
    """The new image of a target, and the batch rows that were not applied."""

    image: DataFrame
    rejects: DataFrame


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           order_by: list[str] | None = None) -> Upserted:
    """MERGE semantics as an image: matched keys take the batch row, new keys
    are inserted, other target rows stay.

    Several batch rows for one key: the latest by ``order_by`` wins; without
    ``order_by`` the job fails, as a MERGE would.  Batch rows with a NULL key
    come back as rejects.  One full outer join of the target with the reduced
    batch; a matched key takes the batch row for every target row of the key,
    so the target must be unique by key (as MERGE keys are).
    """
    good = batch.filter(~any_null(keys))
    latest = latest_per_key(good, keys, order_by) if order_by else unique_per_key(good, keys)
    latest = project_to(latest, target.columns).select(
        *[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.struct(*[qcol(c) for c in target.columns]).alias("__new"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (qcol(k) == F.col(f"__k{i}"))
    joined = target.join(latest, same, "full_outer")
    image = joined.select(*[F.when(F.col("__new").isNotNull(), F.col("__new").getField(c))
                            .otherwise(qcol(c)).alias(c) for c in target.columns])
    return Upserted(image, null_key_rows(batch, keys))


def update_from(target: DataFrame, source: DataFrame, keys: list[str],
                set_cols: dict[str, str]) -> DataFrame:
    """``UPDATE target SET t.c = s.x FROM source s WHERE keys match``.

    ``set_cols`` maps target column -> source column.  A matched source NULL
    overwrites the target value (this is not ``coalesce``).  Several source
    rows for one key fail the job.
    """
    src_cols = list(dict.fromkeys(set_cols.values()))
    src = unique_per_key(source.select(*[qcol(c) for c in keys + src_cols]), keys)
    src = src.select(*[qcol(k) for k in keys], F.lit(True).alias("__matched"),
                     *[qcol(c).alias(f"__s_{c}") for c in src_cols])
    joined = target.join(src, keys, "left")
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col("__matched"), F.col(f"__s_{set_cols[c]}"))
                       .otherwise(qcol(c)).alias(c))
        else:
            out.append(qcol(c))
    return joined.select(*out)


def delete_matching(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE FROM target WHERE key IN (keys_df)`` as an anti join."""
    kept = target.join(keys_df.select(*[qcol(k) for k in keys]), keys, "left_anti")
    return kept.select(*[qcol(c) for c in target.columns])


def replace_where(existing: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """Delete rows matching ``predicate``, then append ``new``.

    Rows where the predicate is NULL are kept, as SQL ``DELETE`` keeps them.
    """
    kept = existing.filter(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(new.select(*[qcol(c) for c in existing.columns]))


def overwrite_partitions(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Replace only the partitions present in ``new``.

    The distinct partition values of the batch are few; the planner broadcasts
    them and the anti join keeps all other partitions of ``existing``.
    """
    parts = new.select(*[qcol(k) for k in keys]).distinct()
    kept = existing.join(parts, keys, "left_anti").select(*[qcol(c) for c in existing.columns])
    return kept.unionByName(new.select(*[qcol(c) for c in existing.columns]))
