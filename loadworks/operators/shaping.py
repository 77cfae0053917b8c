"""Column shaping: rename, pad, cast, project, partition columns, record maps.

All of these build a single ``select`` (one Project node), however many
columns change; loops run over column *names* on the driver, never over rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadworks.functions import scalar as S


def quote(name: str) -> str:
    """Back-quote a column name (names may hold dots, e.g. ``aa.ip_id``)."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote(name))


def base_name(name: str) -> str:
    """Match key of a column: the part after the last dot, upper-cased."""
    return name.rsplit(".", 1)[-1].upper()


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by a source->target map.

    A column matches a map key by its upper-cased full name or by its
    upper-cased base name after the last dot.  Unmapped columns pass through.
    """
    keyed = {k.upper(): v for k, v in mapping.items()}
    exprs = []
    for c in df.columns:
        target = keyed.get(c.upper(), keyed.get(base_name(c)))
        exprs.append(qcol(c).alias(target) if target else qcol(c))
    return df.select(*exprs)


def pad_columns(df: DataFrame, required: list[str], dtype: str = "string") -> DataFrame:
    """Add each required column that is missing as a typed NULL.

    Matching is case-insensitive; new columns follow in ``required`` order.
    """
    present = {c.lower() for c in df.columns}
    extra = [S.null_of(dtype).alias(r) for r in required if r.lower() not in present]
    return df.select(*[qcol(c) for c in df.columns], *extra)


def cast_all_string(df: DataFrame) -> DataFrame:
    """Cast every column to STRING (the shared all-STRING sink layout)."""
    return df.select(*[qcol(c).cast("string").alias(c) for c in df.columns])


def project_to(df: DataFrame, target_cols: list[str]) -> DataFrame:
    """Select the target columns in target order; extra source columns drop.

    A target column missing from the source is an error (the write would fail).
    """
    lookup = {c.lower(): c for c in df.columns}
    missing = [t for t in target_cols if t.lower() not in lookup]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return df.select(*[qcol(lookup[t.lower()]).alias(t) for t in target_cols])


def project_common(df: DataFrame, target_cols: list[str]) -> DataFrame:
    """Case-insensitive intersection of source and target, in target order."""
    lookup = {c.lower(): c for c in df.columns}
    keep = [t for t in target_cols if t.lower() in lookup]
    return df.select(*[qcol(lookup[t.lower()]).alias(t) for t in keep])


def with_partition_columns(df: DataFrame, date_col: str, year_col: str = "ptn_yyyy",
                           month_col: str = "ptn_mm") -> DataFrame:
    """Partition columns from a ``yyyy-MM-dd`` position date (text or date)."""
    text = F.date_format(qcol(date_col), "yyyy-MM-dd") \
        if dict(df.dtypes)[date_col] != "string" else qcol(date_col)
    return df.select("*", F.substring(text, 1, 4).alias(year_col),
                     F.substring(text, 6, 2).alias(month_col))


def derive_table(df: DataFrame, renames: dict[str, str], required: list[str],
                 dtype: str = "string") -> DataFrame:
    """Materialise a derived source: rename by alias map, pad required columns."""
    return pad_columns(rename_columns(df, renames), required, dtype)


@dataclass
class FieldRule:
    """One output column of a flat-file record map.

    kind: ``copy`` | ``mask`` | ``hash`` | ``timestamp`` | ``int`` | ``const``
    | ``run_ts`` | ``expr``.
    """

    target: str
    kind: str = "copy"
    source: str | None = None
    value: object = None


@dataclass
class RecordSpec:
    rules: list[FieldRule] = field(default_factory=list)


def _rule_column(rule: FieldRule, run_ts: str | None) -> Column:
    src = qcol(rule.source) if rule.source else None
    if rule.kind == "copy":
        return src
    if rule.kind == "mask":
        return S.card_mask(src)
    if rule.kind == "hash":
        return S.hash_sha256(src)
    if rule.kind == "timestamp":
        return S.date_text_to_timestamp(src)
    if rule.kind == "int":
        return S.to_int(src)
    if rule.kind == "const":
        return F.lit(rule.value)
    if rule.kind == "run_ts":
        return S.current_ts(run_ts)
    if rule.kind == "expr":
        return rule.value if isinstance(rule.value, Column) else F.expr(str(rule.value))
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def map_record(df: DataFrame, spec: RecordSpec | list[FieldRule],
               run_ts: str | None = None) -> DataFrame:
    """Apply a whole flat-file record mapping as one projection."""
    rules = spec.rules if isinstance(spec, RecordSpec) else spec
    return df.select(*[_rule_column(r, run_ts).alias(r.target) for r in rules])
