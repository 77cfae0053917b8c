"""Audit records, reconciliation and schema-inventory diffs.

The shared audit table is append-only with fourteen STRING columns, so jobs
of any shape can write to it.  Arithmetic on it parses the text with
``try_cast`` to ``decimal(18,2)``: ``'5.00'`` and ``'5'`` compare equal, and
unparsable text becomes NULL with status ``unparsable`` instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadworks.operators.checks import table_counts
from loadworks.operators.shaping import qcol

# The audit table layout, in this order, all STRING.
AUDIT_COLUMNS = ["JOB_NM", "PRJ_NM", "SCMA_NM", "TBL_NM", "SEQ_OR_SCP_NM", "AMT_COL_SRC",
                 "TTL_AMT_SRC", "TTL_REC_SRC", "AMT_COL_TGT", "TTL_AMT_TGT", "TTL_REC_TGT",
                 "POS_DT", "STRT_TMS", "END_TMS"]
OPEN_END_TMS = "9999-12-31 23:59:59"
NUM = "decimal(18,2)"


def _s(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast("string")


def _record(job, project, schema, table, script, amt_col_src, amt_src, rec_src, amt_col_tgt,
            amt_tgt, rec_tgt, pos_dt, started, ended) -> list[Column]:
    vals = [job, project, schema, table, script, amt_col_src, amt_src, rec_src, amt_col_tgt,
            amt_tgt, rec_tgt, pos_dt, started, ended]
    return [_s(v).alias(n) for v, n in zip(vals, AUDIT_COLUMNS)]


def audit_open(positions: DataFrame | SparkSession, job: str, project: str, schema: str,
               table: str, script: str, started: str, pos_dt: str | None = None,
               pos_col: str = "pos_dt") -> DataFrame:
    """Open audit records: amounts ``'0'``, amount columns ``''``, open end.

    ``positions`` is either a frame with one row per position date in
    ``pos_col`` (one record each) or a session plus a single ``pos_dt``.
    """
    if isinstance(positions, SparkSession):
        base = positions.range(1).select(F.lit(pos_dt).alias(pos_col))
    else:
        base = positions.select(qcol(pos_col))
    return base.select(*_record(job, project, schema, table, script, "", "0", "0", "", "0", "0",
                                qcol(pos_col), started, OPEN_END_TMS))


def audit_measure(source: DataFrame, target: DataFrame, amount_src: str, amount_tgt: str,
                  group_col: str, job: str, project: str, schema: str, table: str,
                  script: str, started: str, ended: str) -> DataFrame:
    """Measured records per position (``group_col``): source and target record
    counts and exact amount totals, written as text."""
    s = source.groupBy(qcol(group_col).alias("__pos")).agg(
        F.count(F.lit(1)).alias("__rs"), F.sum(qcol(amount_src).cast(NUM)).alias("__as"))
    t = target.groupBy(qcol(group_col).alias("__pos")).agg(
        F.count(F.lit(1)).alias("__rt"), F.sum(qcol(amount_tgt).cast(NUM)).alias("__at"))
    j = s.join(t, "__pos", "full_outer")
    return j.select(*_record(job, project, schema, table, script, amount_src,
                             F.coalesce("__as", F.lit(0).cast(NUM)), F.coalesce("__rs", F.lit(0)),
                             amount_tgt, F.coalesce("__at", F.lit(0).cast(NUM)),
                             F.coalesce("__rt", F.lit(0)), F.col("__pos"), started, ended))


def _num(c: str) -> Column:
    return F.col(c).try_cast(NUM)


def audit_diff(audit: DataFrame) -> DataFrame:
    """Source minus target record count and amount per audit row."""
    parsed = [_num(c) for c in ("TTL_REC_SRC", "TTL_REC_TGT", "TTL_AMT_SRC", "TTL_AMT_TGT")]
    bad = F.lit(False)
    for p in parsed:
        bad = bad | p.isNull()
    return audit.select("JOB_NM", "TBL_NM", "POS_DT",
                        (parsed[0] - parsed[1]).alias("rec_diff"),
                        (parsed[2] - parsed[3]).alias("amt_diff"),
                        F.when(bad, "unparsable").otherwise("ok").alias("status"))


def reconcile_report(audit: DataFrame) -> DataFrame:
    """Audit rows ordered by job and table with a numeric record-count match."""
    match = F.coalesce(_num("TTL_REC_SRC") == _num("TTL_REC_TGT"), F.lit(False))
    return audit.select("JOB_NM", "TBL_NM", "TTL_REC_SRC", "TTL_REC_TGT", match.alias("rec_match"),
                        "TTL_AMT_SRC", "TTL_AMT_TGT", "POS_DT") \
        .orderBy("JOB_NM", "TBL_NM")


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` for many tables in one job."""
    return table_counts(tables).withColumnRenamed("row_count", "rows")


def table_counts_in(spark: SparkSession, namespace: str,
                    exclude: tuple[str, ...] = ("job_rcncl",)) -> DataFrame:
    """Row count of every table of a namespace (names listed on the driver,
    all counts computed in one job); no rows for a namespace without tables."""
    names = [t.name for t in spark.catalog.listTables(namespace)
             if t.name.lower() not in exclude and not t.isTemporary]
    if not names:
        return spark.createDataFrame([], "table_name string, rows long")
    return count_tables({n: spark.table(f"{namespace}.{n}") for n in names})


def reconcile_counts(src_counts: DataFrame, tgt_counts: DataFrame,
                     exclude: tuple[str, ...] = ("job_rcncl",)) -> DataFrame:
    """Source and target rows per table name; target status populated/empty."""
    s = src_counts.select(F.lower("table_name").alias("table_name"), F.col("rows").alias("source_rows"))
    t = tgt_counts.filter(~F.lower("table_name").isin(*exclude)) \
        .select(F.lower("table_name").alias("table_name"), F.col("rows").alias("target_rows"))
    j = s.join(t, "table_name", "full_outer")
    status = F.when(F.col("target_rows") > 0, "populated") \
        .when(F.col("target_rows") == 0, "empty").otherwise("absent")
    return j.select("table_name", "source_rows", "target_rows", status.alias("target_status"))


def reconcile_summary(counts: DataFrame) -> DataFrame:
    """Totals over ``reconcile_counts``."""
    return counts.agg(
        F.count("source_rows").alias("source_tables"),
        F.coalesce(F.sum("source_rows"), F.lit(0)).cast("long").alias("source_rows"),
        F.count("target_rows").alias("target_tables"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).cast("long").alias("target_rows"),
        F.count_if(F.col("target_rows") > 0).alias("populated"),
        F.count_if(F.col("target_rows") == 0).alias("empty"))


def diff_inventory(src: DataFrame, out: DataFrame) -> DataFrame:
    """Compare two column inventories ``(table_name, column_name, data_type,
    is_partition, object_type)`` with case-insensitive names.

    error: table missing; column missing.  warning: extra column, type
    changed, partitioned source but unpartitioned output.  Column rules apply
    to tables only (views may differ in column form).
    """
    def norm(df):
        return df.select(F.lower("table_name").alias("t"), F.lower("column_name").alias("c"),
                         F.lower(F.trim("data_type")).alias("ty"),
                         F.coalesce(F.col("is_partition"), F.lit(False)).alias("p"),
                         F.lower(F.coalesce("object_type", F.lit("table"))).alias("o"))
    s, o = norm(src), norm(out)
    s_tabs = s.groupBy("t").agg(F.max("o").alias("o"), F.max(F.col("p").cast("int")).alias("sp"))
    o_tabs = o.groupBy("t").agg(F.max(F.col("p").cast("int")).alias("op"))
    missing_tab = s_tabs.join(o_tabs, "t", "left_anti").select(
        F.lit("error").alias("severity"), F.col("t").alias("table_name"),
        F.lit(None).cast("string").alias("column_name"), F.lit("missing_table").alias("issue"),
        F.col("o").alias("detail"))
    both = s_tabs.filter(F.col("o") == "table").join(o_tabs, "t")
    part = both.filter((F.col("sp") == 1) & (F.col("op") == 0)).select(
        F.lit("warning").alias("severity"), F.col("t").alias("table_name"),
        F.lit(None).cast("string").alias("column_name"), F.lit("partition_dropped").alias("issue"),
        F.lit(None).cast("string").alias("detail"))
    keep = both.select("t")
    sc = s.join(keep, "t", "left_semi").select("t", "c", F.col("ty").alias("sty"))
    oc = o.join(keep, "t", "left_semi").select("t", "c", F.col("ty").alias("oty"))
    cols = sc.join(oc, ["t", "c"], "full_outer")
    issue = F.when(F.col("oty").isNull() & F.col("sty").isNotNull(), "missing_column") \
        .when(F.col("sty").isNull(), "extra_column") \
        .when(F.col("sty") != F.col("oty"), "type_changed")
    col_issues = cols.select(
        F.when(issue == "missing_column", "error").otherwise("warning").alias("severity"),
        F.col("t").alias("table_name"), F.col("c").alias("column_name"), issue.alias("issue"),
        F.when(issue == "type_changed", F.concat("sty", F.lit(" -> "), "oty")).alias("detail")) \
        .filter(F.col("issue").isNotNull())
    return missing_tab.unionByName(part).unionByName(col_issues)


# ------------------------------------------------------------------ drill-down

TREE_BITS = (4, 8, 12)  # nodes of a level: 2 ** bits; the last level has the leaves


def leaf_of(keys: list[str], bits: int = TREE_BITS[-1]) -> Column:
    """The leaf of a row's key: the low bits of its hash."""
    return F.xxhash64(*[qcol(k) for k in keys]).bitwiseAND((1 << bits) - 1).cast("int")


def hash_tree(image: DataFrame, keys: list[str], bits: tuple[int, ...] = TREE_BITS) -> DataFrame:
    """``(level, node, n, total, mixed)``: the digests of an image by ranges of hashed keys.

    One pass over the image, combined before the shuffle: what is shuffled is a row a
    leaf and task.  A digest is the number of rows, the sum of a 64-bit hash of each row
    and the exclusive or of a second one, so swapped values show that leave counts
    and sums as they are.  Nodes of upper levels are sums of leaves.  Trees can be
    stored and compared without their images.
    """
    cols = [qcol(c) for c in sorted(image.columns)]
    leaves = image.groupBy(leaf_of(keys, bits[-1]).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("second"), *cols)).alias("mixed"))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.col("leaf").bitwiseAND((1 << b) - 1).alias("node"))
                       for i, b in enumerate(bits)])
    return leaves.select(F.inline(levels), "n", "total", "mixed").groupBy("level", "node").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed"))


def differing_leaves(left: DataFrame, right: DataFrame, bits: tuple[int, ...] = TREE_BITS) -> DataFrame:
    """``(leaf)`` of two stored trees that differ, found from the top: a level is looked at only below
    nodes of the level above that differ."""
    above = None
    for i, b in enumerate(bits):
        sides = [t.filter(F.col("level") == i).select("node", F.struct("n", "total", "mixed").alias(name))
                 for t, name in ((left, "l"), (right, "r"))]
        both = sides[0].join(sides[1], "node", "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")))
        if above is not None:
            parent = F.col("node").bitwiseAND((1 << bits[i - 1]) - 1)
            both = both.join(above, parent == F.col("parent"), "left_semi")
        above = both.select(F.col("node").alias("parent"))
    return above.select(F.col("parent").alias("leaf"))


def diff_images(left: DataFrame, right: DataFrame, leaves: DataFrame, keys: list[str],
                bits: tuple[int, ...] = TREE_BITS, leaf_col: str | None = None) -> DataFrame:
    """``(keys..., status, columns)`` of the rows of some leaves that are not the same in both images.

    ``status``: ``missing`` (only left), ``extra`` (only right) or ``changed``, with the names of the
    columns that differ.  Only rows of the given leaves are joined; images stored by
    ``leaf_col`` (partitioned by ``leaf_of``) are read in those partitions only.  Rows that are
    the same in both are left out; keys must be unique in an image.
    """
    names = [c for c in left.columns if c not in keys and c != leaf_col]
    wanted = leaves.select(F.col("leaf").alias("__leaf"))

    def side(image: DataFrame, name: str) -> DataFrame:
        own = qcol(leaf_col) if leaf_col else leaf_of(keys, bits[-1])
        return image.join(wanted, own == F.col("__leaf"), "left_semi").select(
            *[qcol(k).alias(f"__{name}{i}") for i, k in enumerate(keys)], F.struct(*[qcol(c) for c in names]).alias(name))

    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"__l{i}").eqNullSafe(F.col(f"__r{i}"))
    both = side(left, "l").join(side(right, "r"), same, "full_outer")
    differ = F.filter(F.array(*[F.when(~F.col("l")[c].eqNullSafe(F.col("r")[c]), F.lit(c)) for c in names]),
                      lambda c: c.isNotNull())
    status = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra") \
        .when(F.size(differ) > 0, "changed")
    return both.select(*[F.coalesce(f"__l{i}", f"__r{i}").alias(k) for i, k in enumerate(keys)], status.alias("status"),
                       F.when(status == "changed", F.array_join(differ, ",")).alias("columns")) \
        .filter(F.col("status").isNotNull())
