"""Lookup enrichment: a main table left-joined to many lookup tables.

Plan shape
----------
* Each lookup is first reduced to one row per key (``dedupe``), so a lookup
  with repeated keys can never multiply main rows.  The reduction is a
  ``groupBy`` with map-side partial aggregation; its output is already hash
  partitioned on the key, so a sort-merge join against the main table reuses
  that partitioning instead of shuffling the lookup again.
* No broadcast hint by default: the planner broadcasts a side only when its
  estimated size is below ``spark.sql.autoBroadcastJoinThreshold`` and AQE
  re-checks the real size after the lookup stage ran.  Bigger lookups stay a
  shuffle join, and AQE splits skewed main-table keys.
* A lookup that is known to be unique by key (``unique=True``) is not reduced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadworks.operators.shaping import qcol


@dataclass
class Lookup:
    """One lookup of ``enrich``.

    on:   list of shared key names, or a dict ``main_column -> lookup_column``
          for differently named keys.
    cols: lookup columns to bring (default: every non-key column).
    how:  ``left`` (row count of main preserved) or ``inner``.
    unique: the caller states that keys are unique; the reduction is skipped.
    """

    df: DataFrame
    on: list[str] | dict[str, str]
    cols: list[str] | None = None
    how: str = "left"
    unique: bool = False


def dedupe_on(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row per key: the smallest row by value among duplicates.

    Deterministic whatever the input order; partial aggregation removes the
    duplicates before the shuffle.
    """
    if not cols:
        return df.select(*[qcol(k) for k in keys]).distinct()
    packed = F.min(F.struct(*[qcol(c) for c in cols])).alias("__row")
    return df.groupBy(*[qcol(k) for k in keys]).agg(packed) \
        .select(*[qcol(k) for k in keys], *[F.col("__row").getField(c).alias(c) for c in cols])


def _key_pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, dict):
        return list(on.items())
    if isinstance(on, str):
        return [(on, on)]
    return [(k, k) for k in on]


def enrich(main: DataFrame, lookups: list[Lookup], dedupe: bool = True) -> DataFrame:
    """Join ``main`` to each lookup in turn.

    Later lookups may join on columns brought by earlier ones (for example a
    customer's nation key, then the nation's region key).  Lookup key columns
    are not repeated in the output; with ``how='left'`` the row count of
    ``main`` is preserved when ``dedupe`` is on.
    """
    out = main
    for i, lk in enumerate(lookups):
        pairs = _key_pairs(lk.on)
        lkp_keys = [b for _, b in pairs]
        cols = lk.cols if lk.cols is not None else \
            [c for c in lk.df.columns if c not in lkp_keys]
        side = dedupe_on(lk.df, lkp_keys, cols) if dedupe and not lk.unique else \
            lk.df.select(*[qcol(c) for c in lkp_keys + cols])
        tmp = {b: f"__k{i}_{j}" for j, b in enumerate(lkp_keys)}
        side = side.select(*[qcol(b).alias(tmp[b]) for b in lkp_keys], *[qcol(c) for c in cols])
        cond: Column | None = None
        for a, b in pairs:
            term = qcol(a) == F.col(tmp[b])
            cond = term if cond is None else cond & term
        out = out.join(side, cond, lk.how).drop(*tmp.values())
    return out
