"""Post-load validation suites and profiling aggregates.

Each suite returns ``(check_name, status, detail, measure)`` with status in
PASS / WARN / FAIL / SKIP.  A suite reads each table once: all its counts
are conditional aggregates of a single ``agg``; the SCD2 suite finds next
versions on (key, day) buckets and counts per key with partial aggregation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loadworks.operators.sequence import add_bucket, time_bucket, with_neighbour
from loadworks.operators.shaping import qcol
from loadworks.operators.verdict import check, combine_metrics, percent, rows
from loadworks.sources.files import block_summaries, fold_blocks

OPEN_END = "9999-12-31"

# Words that mark a header or trailer row leaking into data.
HEADER_PATTERN = r"^(header|trailer|hdr|trl|record_count|total|footer|h\|)"


def _status(cond_pass: Column, fail: str = "FAIL") -> Column:
    return F.when(cond_pass, F.lit("PASS")).otherwise(F.lit(fail))


# ---------------------------------------------------------------- profiling

def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percent per column, from one aggregate over ``df``."""
    cols = columns or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(qcol(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("nulls"),
                        F.col("__rows").alias("row_count"),
                        percent(F.col(f"__n{i}"), F.col("__rows")).alias("null_pct"))
               for i, c in enumerate(cols)]
    return agg.select(F.inline(F.array(*entries)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1``, with the count."""
    return df.groupBy(*[qcol(k) for k in keys]).agg(F.count(F.lit(1)).alias("cnt")) \
        .filter(F.col("cnt") > 1)


def partition_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a partition column (sorted)."""
    return df.select(qcol(col)).distinct().orderBy(qcol(col))


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows by a key order (top-k per partition, then merged)."""
    return df.orderBy(*[qcol(c) for c in order_by]).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table as ``(table_name, row_count)`` in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- suites

def check_multi_join(main: DataFrame, target: DataFrame, lookup_cols: list[str],
                     audit_cols: list[str]) -> DataFrame:
    """Row count kept, lookup columns not (mostly) NULL, audit columns present."""
    m = main.agg(F.count(F.lit(1)).alias("main_rows"))
    t = target.agg(F.count(F.lit(1)).alias("target_rows"),
                   *[F.count_if(qcol(c).isNull()).alias(f"null_{i}")
                     for i, c in enumerate(lookup_cols)])
    one = combine_metrics(m, t)
    diff = F.col("target_rows") - F.col("main_rows")
    checks = [check("Row count match", _status(diff == 0, "WARN"),
                    F.when(diff != 0, F.concat(F.lit("diff="), diff.cast("string"))),
                    diff)]
    rows_c = F.col("target_rows")
    for i, c in enumerate(lookup_cols):
        nulls = F.col(f"null_{i}")
        pct = percent(nulls, rows_c)
        status = F.when((rows_c > 0) & (nulls == rows_c), "FAIL") \
            .when(nulls * 2 > rows_c, "WARN").otherwise("PASS")
        checks.append(check(f"Lookup {c}", status,
                            F.concat(pct.cast("string"), F.lit("% NULL")), pct))
    present = {c.lower() for c in target.columns}
    for c in audit_cols:
        ok = c.lower() in present
        checks.append(check(f"Audit col {c}", F.lit("PASS" if ok else "FAIL"),
                            F.lit(None if ok else "missing from target")))
    return rows(one, checks)


def _date(c: Column) -> Column:
    return c.cast("date")


def check_scd2(dim: DataFrame, keys: list[str], flag: str = "is_current",
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               strict: bool = False, bucket: str | None = "day") -> DataFrame:
    """SCD2 invariants; all verdicts come from one aggregate.  ``bucket`` is the time
    slice that splits hot keys (see ``sequence``).

    1. no key has more than one current row (strict: nor zero);
    2. current rows end at 9999-12-31 (strict: NULL ends count as bad);
    3. superseded rows do not end at 9999-12-31;
    4. each version ends on the day the next one starts (strict: NULL end
       before a next version counts as a gap).
    """
    vt = _date(qcol(valid_to))
    staged, bcol = add_bucket(dim, keys, time_bucket(valid_from, bucket) if bucket else None)
    with_next = with_neighbour(staged, keys, [valid_from], qcol(valid_from), "__next", "next",
                               bcol)
    nxt_v = F.col("__next").getField("v")
    is_cur = qcol(flag) == F.lit(True)
    is_old = qcol(flag) == F.lit(False)
    open_end = F.lit(OPEN_END).cast("date")
    per_row = with_next.select(
        *[qcol(k) for k in keys],
        is_cur.alias("__cur"),
        (is_cur & ((vt != open_end) | (vt.isNull() if strict else F.lit(False)))).alias("__bad_cur"),
        (is_old & (vt == open_end)).alias("__open_old"),
        (nxt_v.isNotNull() & ((vt != _date(nxt_v)) | (vt.isNull() if strict else F.lit(False))))
        .alias("__gap"),
    )
    # Per-key counts use partial aggregation, so hot keys are pre-combined.
    per_key = per_row.groupBy(*[qcol(k) for k in keys]).agg(
        F.count_if(F.coalesce(F.col("__cur"), F.lit(False))).alias("cur"),
        F.count_if(F.coalesce(F.col("__bad_cur"), F.lit(False))).alias("bad_cur"),
        F.count_if(F.coalesce(F.col("__open_old"), F.lit(False))).alias("open_old"),
        F.count_if(F.coalesce(F.col("__gap"), F.lit(False))).alias("gaps"),
    )
    one = per_key.agg(
        F.count_if(F.col("cur") > 1).alias("multi_cur"),
        F.count_if(F.col("cur") == 0).alias("no_cur"),
        F.coalesce(F.sum("bad_cur"), F.lit(0)).alias("bad_cur"),
        F.coalesce(F.sum("open_old"), F.lit(0)).alias("open_old"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
    )
    dup = F.col("multi_cur") + (F.col("no_cur") if strict else F.lit(0))
    checks = [
        check("Unique current record per BK", _status(dup == 0),
              F.when(dup > 0, F.concat(dup.cast("string"), F.lit(" keys"))), dup),
        check("Current valid_to = 9999-12-31", _status(F.col("bad_cur") == 0),
              F.when(F.col("bad_cur") > 0, F.concat(F.col("bad_cur").cast("string"), F.lit(" rows"))),
              F.col("bad_cur")),
        check("Superseded records closed", _status(F.col("open_old") == 0),
              F.when(F.col("open_old") > 0,
                     F.concat(F.col("open_old").cast("string"), F.lit(" rows"))),
              F.col("open_old")),
        check("No date gaps", _status(F.col("gaps") == 0),
              F.when(F.col("gaps") > 0, F.concat(F.col("gaps").cast("string"), F.lit(" gaps"))),
              F.col("gaps")),
    ]
    return rows(one, checks)


def first_string_column(df: DataFrame) -> str | None:
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            return f.name
    return None


def check_file_ingestion(staging: DataFrame, target: DataFrame, expected: int | DataFrame,
                         partition_cols: list[str] | None = None) -> DataFrame:
    """Expected count reached, partitions present, no header/trailer leakage.

    ``expected`` is a number or a one-row frame with an ``expected`` column
    (for instance a control-file record count), kept lazy.
    """
    partition_cols = partition_cols or []
    text_col = first_string_column(target)
    s = staging.agg(F.count(F.lit(1)).alias("staging_rows"))
    t_aggs = [F.count(F.lit(1)).alias("target_rows")]
    # a partition column has few values: they are listed
    t_aggs += [F.array_sort(F.collect_set(qcol(c).cast("string"))).alias(f"pv_{i}")
               for i, c in enumerate(partition_cols)]
    if text_col is not None:
        t_aggs.append(F.count_if(F.coalesce(
            F.lower(qcol(text_col)).rlike(HEADER_PATTERN), F.lit(False))).alias("leaks"))
    if isinstance(expected, DataFrame):
        one = combine_metrics(s, target.agg(*t_aggs),
                              expected.select(F.col("expected").cast("long").alias("expected")))
        exp = F.col("expected")
    else:
        one = combine_metrics(s, target.agg(*t_aggs))
        exp = F.lit(expected).cast("long")
    tr, sr = F.col("target_rows"), F.col("staging_rows")
    checks = [check("Target count matches expected",
                    F.when(tr == exp, "PASS").when(sr == exp, "WARN").otherwise("FAIL"),
                    F.concat(F.lit("target="), tr.cast("string"), F.lit(" staging="),
                             sr.cast("string")), tr - exp)]
    if partition_cols:
        for i, c in enumerate(partition_cols):
            found = F.size(f"pv_{i}")
            checks.append(check(f"Partitions present {c}", F.lit("PASS"),
                                F.concat(found.cast("string"), F.lit(" distinct values: "),
                                         F.array_join(f"pv_{i}", ", ")), found))
    else:
        checks.append(check("Partitions present", F.lit("SKIP"), F.lit("no partition cols defined")))
    if text_col is not None:
        lk = F.col("leaks")
        checks.append(check("No header/footer leakage", _status(lk == 0, "WARN"),
                            F.concat(F.lit(f"column {text_col}: "), lk.cast("string"),
                                     F.lit(" suspicious rows")), lk))
    else:
        checks.append(check("No header/footer leakage", F.lit("SKIP"), F.lit("no string column")))
    return rows(one, checks)


def check_generic(tables: dict[str, DataFrame]) -> DataFrame:
    """Each table has rows and has columns; one count per table, one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n"))
        ncols = len(df.columns)
        part = rows(one, [
            check(f"{name} has rows", _status(F.col("n") > 0),
                  F.concat(F.col("n").cast("string"), F.lit(" rows")), F.col("n")),
            check(f"{name} schema non-empty", F.lit("PASS" if ncols > 0 else "FAIL"),
                  F.lit(f"{ncols} columns"), F.lit(ncols)),
        ])
        out = part if out is None else out.unionByName(part)
    return out


def generic_samples(tables: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """``(table_name, sample)``: the first rows of each table as JSON text, by that text."""
    out = None
    for name, df in tables.items():
        part = sample_rows(df.select(F.to_json(F.struct(*[qcol(c) for c in df.columns])).alias("sample")),
                           n, ["sample"]).select(F.lit(name).alias("table_name"), "sample")
        out = part if out is None else out.unionByName(part)
    return out


def check_control_file(lines: DataFrame, sep: str, width: int, file_col: str = "file",
                       line_no_col: str = "line_no", text_col: str = "line") -> DataFrame:
    """Control-record check of landed files, one row per file.

    ``lines`` has one row per non-blank line with its 1-based number.  The first
    line is the header, the last the trailer; the trailer's last field holds the
    detail count.  Checks: header and trailer present (at least two lines), every
    detail line has ``width`` fields, trailer count = detail lines.
    """
    nfields = F.size(F.split(qcol(text_col), _regex_literal(sep), -1))
    w_lines = lines.select(
        qcol(file_col), qcol(line_no_col), qcol(text_col), nfields.alias("nf"))
    per_file = w_lines.groupBy(qcol(file_col)).agg(
        F.count(F.lit(1)).alias("filled"),
        F.element_at(F.split(F.max_by(qcol(text_col), qcol(line_no_col)), _regex_literal(sep), -1), -1)
        .try_cast("long").alias("last_value"),
        F.sum(F.when(F.col("nf") != width, 1).otherwise(0)).alias("bad"),
        F.max_by(F.col("nf"), qcol(line_no_col)).alias("last_fields"),
        F.min_by(F.col("nf"), qcol(line_no_col)).alias("first_fields"),
    )
    return _control_verdict(per_file, file_col, width)


def check_control_files(spark: SparkSession, path: str, sep: str, width: int) -> DataFrame:
    """``check_control_file`` of all files below ``path``, from block summaries: one scan,
    and no line is moved (see ``sources.files.block_summaries``)."""
    return _control_verdict(fold_blocks(block_summaries(spark, path, sep, width)).filter("filled > 0"), "file", width)


def _control_verdict(per_file: DataFrame, file_col: str, width: int) -> DataFrame:
    """The check's row from a file's counts of non-blank lines."""
    details = F.col("filled") - 2
    bad_width = F.col("bad") - F.when(F.col("first_fields") != width, 1).otherwise(0) \
        - F.when(F.col("last_fields") != width, 1).otherwise(0)
    has_ctl = F.col("filled") >= 2
    return per_file.select(
        qcol(file_col),
        has_ctl.alias("has_control_records"),
        F.greatest(details, F.lit(0)).cast("long").alias("detail_lines"),
        F.when(has_ctl, bad_width).otherwise(F.lit(0)).cast("long").alias("bad_width_lines"),
        F.col("last_value").alias("trailer_count"),
        F.when(has_ctl & (bad_width == 0) & (F.col("last_value") == details), "PASS")
        .otherwise("FAIL").alias("status"),
    )


def _regex_literal(sep: str) -> str:
    return re.escape(sep)


SUITES = ("scd2", "file_ingestion", "multi_join", "generic")


def run_suite(pattern: str, **params) -> DataFrame:
    """Pick the suite by load pattern; anything unknown runs the generic one."""
    if pattern == "scd2":
        return check_scd2(params["dim"], params["keys"], params.get("flag", "is_current"),
                          params.get("valid_from", "valid_from"),
                          params.get("valid_to", "valid_to"), params.get("strict", False))
    if pattern == "file_ingestion":
        return check_file_ingestion(params["staging"], params["target"], params["expected"],
                                    params.get("partition_cols"))
    if pattern == "multi_join":
        return check_multi_join(params["main"], params["target"], params["lookup_cols"],
                                params.get("audit_cols", []))
    return check_generic(params["tables"])
