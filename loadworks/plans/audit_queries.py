"""Queries for control totals, ingestion checks, audit and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadworks.operators import audit as AU
from loadworks.operators import checks as C
from loadworks.operators import control as CT
from loadworks.plans import scd_queries as SQ
from loadworks.plans import shaping_queries as SH
from loadworks.plans.registry import ALL_TABLES, recipe, table
from loadworks.session import scratch_database, scratch_path
from loadworks.sources.journal import append_once
from loadworks.sources.namespaces import Namespaces
from loadworks.sources import sinks as K

IDS = dict(job="LOAD_ORDERS", project="SALES", schema="tgt", table="orders",
           script="load_orders", started="2024-01-15 06:00:00")
ENDED = "2024-01-15 06:30:00"


# ------------------------------------------------------------ control records

@recipe("control_totals", """
SELECT o_orderstatus, count(*) AS ttl_rec, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS ttl_amt
FROM orders GROUP BY o_orderstatus
""")
def q_control_totals(spark, sf):
    return CT.control_totals(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice")


def _union(spark, sf):
    return CT.union_control_detail(table(spark, sf, "orders"), ["o_orderstatus"],
                                   ["o_orderkey", "o_totalprice"], "o_totalprice")


@recipe("union_control_detail", """
SELECT 'control' AS kind, o_orderstatus, count(*) AS n,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'detail', o_orderstatus, count(*), sum(CAST(o_totalprice AS DECIMAL(18,2)))
FROM orders GROUP BY o_orderstatus
""")
def q_union_control_detail(spark, sf):
    u = _union(spark, sf)
    ctl = u.filter(F.col("o_orderkey").isNull()).select(
        F.lit("control").alias("kind"), "o_orderstatus", F.col("ttl_rec").alias("n"),
        F.col("ttl_amt").alias("amount"))
    det = u.filter(F.col("o_orderkey").isNotNull()).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")) \
        .select(F.lit("detail").alias("kind"), "o_orderstatus", "n", "amount")
    return ctl.unionByName(det)


@recipe("split_control_detail", """
SELECT o_orderstatus, count(*) AS control_rec, count(*) AS detail_rec,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS control_amt,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS detail_amt, 'PASS' AS status
FROM orders GROUP BY o_orderstatus
""")
def q_split_control_detail(spark, sf):
    control, detail = CT.split_control_detail(_union(spark, sf), ["o_orderstatus"], "o_orderkey",
                                              "o_totalprice")
    return CT.reconcile_control(control, detail, ["o_orderstatus"], "o_totalprice")


# ------------------------------------------------------------ ingestion check

def _ingestion_frames(spark, sf):
    p = table(spark, sf, "part")
    staging = p.select("p_partkey",
                       F.when(F.col("p_size") <= 2, F.concat(F.lit("Trailer "), "p_name"))
                       .otherwise(F.col("p_name")).alias("p_name"), "p_brand", "p_size")
    target = staging.filter(F.col("p_size") <= 45)
    expected = staging.agg(F.count(F.lit(1)).alias("expected"))
    return staging, target, expected


INGEST_SQL = f"""
SELECT * FROM (
WITH st AS (SELECT p_partkey, CASE WHEN p_size <= 2 THEN 'Trailer ' || p_name ELSE p_name END AS p_name,
                   p_brand, p_size FROM part),
tg AS (SELECT * FROM st WHERE p_size <= 45),
a AS (SELECT (SELECT count(*) FROM st) AS sr, (SELECT count(*) FROM tg) AS tr,
             (SELECT count(DISTINCT p_brand) FROM tg) AS pv,
             (SELECT string_agg(p_brand, ', ' ORDER BY p_brand) FROM (SELECT DISTINCT p_brand FROM tg) d) AS pl,
             (SELECT count(*) FROM tg WHERE regexp_matches(lower(p_name),
                '^(header|trailer|hdr|trl|record_count|total|footer|h\\|)')) AS leaks)
SELECT 'Target count matches expected' AS check_name,
       CASE WHEN tr = sr THEN 'PASS' ELSE 'WARN' END AS status,
       'target=' || CAST(tr AS VARCHAR) || ' staging=' || CAST(sr AS VARCHAR) AS detail,
       CAST(tr - sr AS DECIMAL(20,2)) AS measure FROM a
UNION ALL
SELECT 'Partitions present p_brand', 'PASS', CAST(pv AS VARCHAR) || ' distinct values: ' || pl,
       CAST(pv AS DECIMAL(20,2)) FROM a
UNION ALL
SELECT 'No header/footer leakage', CASE WHEN leaks = 0 THEN 'PASS' ELSE 'WARN' END,
       'column p_name: ' || CAST(leaks AS VARCHAR) || ' suspicious rows',
       CAST(leaks AS DECIMAL(20,2)) FROM a)
"""


@recipe("check_file_ingestion", INGEST_SQL)
def q_check_file_ingestion(spark, sf):
    staging, target, expected = _ingestion_frames(spark, sf)
    return C.check_file_ingestion(staging, target, expected, ["p_brand"])


def _generic_sql(names):
    rows = [f"SELECT '{t} has rows' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END "
            f"AS status, CAST(count(*) AS VARCHAR) || ' rows' AS detail, "
            f"CAST(count(*) AS DECIMAL(20,2)) AS measure FROM {t}" for t in names]
    rows += [f"SELECT '{t} schema non-empty', 'PASS', '{SH._NCOLS[t]} columns', "
             f"CAST({SH._NCOLS[t]} AS DECIMAL(20,2))" for t in names]
    return "SELECT * FROM (" + "\nUNION ALL\n".join(rows) + ")"


SUITE_SQL = "\nUNION ALL\n".join([
    "SELECT 'scd2' AS suite, check_name, status, detail, measure FROM ("
    + SQ._check_sql("clean", SQ.BUILD_SQL, False) + ")",
    "SELECT 'file_ingestion' AS suite, * FROM (" + INGEST_SQL + ")",
    "SELECT 'multi_join' AS suite, * FROM (" + SH.CHECK_MULTI_JOIN_SQL + ")",
    "SELECT 'generic' AS suite, * FROM (" + _generic_sql(["customer", "orders"]) + ")",
    "SELECT 'cdc_merge' AS suite, * FROM (" + _generic_sql(["customer", "orders"]) + ")",
])


@recipe("check_run_suite", SUITE_SQL)
def q_check_run_suite(spark, sf):
    dim = SQ.stored_dimension(spark, table(spark, sf, "events"))
    staging, target, expected = _ingestion_frames(spark, sf)
    docs, enriched = SH._documents_enriched(spark, sf)
    generic = {"customer": table(spark, sf, "customer"), "orders": table(spark, sf, "orders")}
    runs = {
        "scd2": dict(dim=dim, keys=SQ.KEYS),
        "file_ingestion": dict(staging=staging, target=target, expected=expected,
                               partition_cols=["p_brand"]),
        "multi_join": dict(main=docs, target=enriched,
                           lookup_cols=["quality", "never_name", "lang_code"],
                           audit_cols=["lang", "load_ts"]),
        "generic": dict(tables=generic),
        "cdc_merge": dict(tables=generic),
    }
    out = None
    for pattern, params in runs.items():
        part = C.run_suite(pattern, **params).select(F.lit(pattern).alias("suite"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------ audit

def _positions(spark, sf):
    return table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pos_dt")).distinct()


def _lit_ids():
    return (f"'{IDS['job']}' AS JOB_NM, '{IDS['project']}' AS PRJ_NM, '{IDS['schema']}' AS SCMA_NM, "
            f"'{IDS['table']}' AS TBL_NM, '{IDS['script']}' AS SEQ_OR_SCP_NM")


@recipe("audit_open", f"""
SELECT {_lit_ids()}, '' AS AMT_COL_SRC, '0' AS TTL_AMT_SRC, '0' AS TTL_REC_SRC, '' AS AMT_COL_TGT,
       '0' AS TTL_AMT_TGT, '0' AS TTL_REC_TGT, pos_dt AS POS_DT, '{IDS['started']}' AS STRT_TMS,
       '9999-12-31 23:59:59' AS END_TMS
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS pos_dt FROM orders)
""")
def q_audit_open(spark, sf):
    return AU.audit_open(_positions(spark, sf), **IDS)


def _measure(spark, sf):
    o = table(spark, sf, "orders").withColumn("pos_year", F.date_format("o_orderdate", "yyyy"))
    return AU.audit_measure(o, o.filter(F.col("o_orderstatus") != "F"), "o_totalprice",
                            "o_totalprice", "pos_year", ended=ENDED, **IDS)


MEASURE_SQL = f"""
SELECT * FROM (
WITH s AS (SELECT strftime(o_orderdate, '%Y') AS pos, count(*) AS rs,
                  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders GROUP BY 1),
t AS (SELECT strftime(o_orderdate, '%Y') AS pos, count(*) AS rt,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS b FROM orders
      WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT {_lit_ids()}, 'o_totalprice' AS AMT_COL_SRC, CAST(coalesce(s.a, 0) AS VARCHAR) AS TTL_AMT_SRC,
       CAST(coalesce(s.rs, 0) AS VARCHAR) AS TTL_REC_SRC, 'o_totalprice' AS AMT_COL_TGT,
       CAST(coalesce(t.b, 0) AS VARCHAR) AS TTL_AMT_TGT, CAST(coalesce(t.rt, 0) AS VARCHAR) AS TTL_REC_TGT,
       coalesce(s.pos, t.pos) AS POS_DT, '{IDS['started']}' AS STRT_TMS, '{ENDED}' AS END_TMS
FROM s FULL JOIN t ON s.pos = t.pos)
"""


@recipe("audit_measure", MEASURE_SQL)
def q_audit_measure(spark, sf):
    return _measure(spark, sf)


def _odd_row(spark, rec_src, rec_tgt, amt_src="10.00", amt_tgt="10.00"):
    return spark.range(1).select(
        F.lit("LOAD_MANUAL").alias("JOB_NM"), F.lit("SALES").alias("PRJ_NM"),
        F.lit("tgt").alias("SCMA_NM"), F.lit("manual").alias("TBL_NM"),
        F.lit("manual").alias("SEQ_OR_SCP_NM"), F.lit("amt").alias("AMT_COL_SRC"),
        F.lit(amt_src).alias("TTL_AMT_SRC"), F.lit(rec_src).alias("TTL_REC_SRC"),
        F.lit("amt").alias("AMT_COL_TGT"), F.lit(amt_tgt).alias("TTL_AMT_TGT"),
        F.lit(rec_tgt).alias("TTL_REC_TGT"), F.lit("2024-01-15").alias("POS_DT"),
        F.lit(IDS["started"]).alias("STRT_TMS"), F.lit(ENDED).alias("END_TMS"))


def _odd_sql(rec_src, rec_tgt):
    return (f"SELECT 'LOAD_MANUAL' AS JOB_NM, 'SALES' AS PRJ_NM, 'tgt' AS SCMA_NM, 'manual' AS TBL_NM, "
            f"'manual' AS SEQ_OR_SCP_NM, 'amt' AS AMT_COL_SRC, '10.00' AS TTL_AMT_SRC, "
            f"'{rec_src}' AS TTL_REC_SRC, 'amt' AS AMT_COL_TGT, '10.00' AS TTL_AMT_TGT, "
            f"'{rec_tgt}' AS TTL_REC_TGT, '2024-01-15' AS POS_DT, '{IDS['started']}' AS STRT_TMS, "
            f"'{ENDED}' AS END_TMS")


@recipe("audit_diff", f"""
WITH a AS ({MEASURE_SQL} UNION ALL {_odd_sql('n/a', '5')}),
p AS (SELECT JOB_NM, TBL_NM, POS_DT,
             TRY_CAST(TTL_REC_SRC AS DECIMAL(18,2)) AS rs, TRY_CAST(TTL_REC_TGT AS DECIMAL(18,2)) AS rt,
             TRY_CAST(TTL_AMT_SRC AS DECIMAL(18,2)) AS a_s, TRY_CAST(TTL_AMT_TGT AS DECIMAL(18,2)) AS a_t
      FROM a)
SELECT JOB_NM, TBL_NM, POS_DT, rs - rt AS rec_diff, a_s - a_t AS amt_diff,
       CASE WHEN rs IS NULL OR rt IS NULL OR a_s IS NULL OR a_t IS NULL THEN 'unparsable'
            ELSE 'ok' END AS status
FROM p
""")
def q_audit_diff(spark, sf):
    return AU.audit_diff(_measure(spark, sf).unionByName(_odd_row(spark, "n/a", "5")))


@recipe("reconcile_report", f"""
WITH a AS ({MEASURE_SQL} UNION ALL {_odd_sql('5.00', '5')})
SELECT JOB_NM, TBL_NM, TTL_REC_SRC, TTL_REC_TGT,
       coalesce(TRY_CAST(TTL_REC_SRC AS DECIMAL(18,2)) = TRY_CAST(TTL_REC_TGT AS DECIMAL(18,2)), false)
         AS rec_match,
       TTL_AMT_SRC, TTL_AMT_TGT, POS_DT
FROM a
""")
def q_reconcile_report(spark, sf):
    return AU.reconcile_report(_measure(spark, sf).unionByName(_odd_row(spark, "5.00", "5")))


def _target_tables(spark, sf):
    t = {n: table(spark, sf, n) for n in ALL_TABLES}
    return {
        "orders": t["orders"].filter(F.col("o_orderstatus") != "F"),
        "customer": t["customer"],
        "lineitem": t["lineitem"].filter(F.col("l_returnflag") == "N"),
        "supplier": t["supplier"].filter(F.col("s_acctbal") < -100000),
        "region": t["region"], "nation": t["nation"], "events": t["events"],
        "JOB_RCNCL": _measure(spark, sf),
    }


_TARGET_SQL = {
    "orders": "SELECT count(*) FROM orders WHERE o_orderstatus <> 'F'",
    "customer": "SELECT count(*) FROM customer",
    "lineitem": "SELECT count(*) FROM lineitem WHERE l_returnflag = 'N'",
    "supplier": "SELECT count(*) FROM supplier WHERE s_acctbal < -100000",
    "region": "SELECT count(*) FROM region", "nation": "SELECT count(*) FROM nation",
    "events": "SELECT count(*) FROM events",
}

COUNTS_SQL = f"""
WITH s AS ({" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ALL_TABLES)}),
t AS ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, ({q}) AS rows" for n, q in _TARGET_SQL.items())})
SELECT coalesce(s.table_name, t.table_name) AS table_name, s.rows AS source_rows, t.rows AS target_rows,
       CASE WHEN t.rows > 0 THEN 'populated' WHEN t.rows = 0 THEN 'empty' ELSE 'absent' END
         AS target_status
FROM s FULL JOIN t ON s.table_name = t.table_name
"""


def _counts(spark, sf):
    src = AU.count_tables({n: table(spark, sf, n) for n in ALL_TABLES})
    tgt = AU.count_tables(_target_tables(spark, sf))
    return AU.reconcile_counts(src, tgt)


@recipe("reconcile_counts", COUNTS_SQL)
def q_reconcile_counts(spark, sf):
    return _counts(spark, sf)


@recipe("reconcile_summary", f"""
SELECT count(source_rows) AS source_tables, CAST(coalesce(sum(source_rows), 0) AS BIGINT) AS source_rows,
       count(target_rows) AS target_tables, CAST(coalesce(sum(target_rows), 0) AS BIGINT) AS target_rows,
       count(*) FILTER (WHERE target_rows > 0) AS populated,
       count(*) FILTER (WHERE target_rows = 0) AS empty
FROM ({COUNTS_SQL}) c
""")
def q_reconcile_summary(spark, sf):
    return AU.reconcile_summary(_counts(spark, sf))


@recipe("reconcile_namespaces", f"""
SELECT * FROM ({COUNTS_SQL}) c WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'orders', 'lineitem')
""")
def q_reconcile_namespaces(spark, sf):
    """Both sides stored in namespaces of their own, listed and counted there."""
    ns = Namespaces(spark, scratch_database(spark), scratch_database(spark))
    for n in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        table(spark, sf, n).write.format("parquet").saveAsTable(f"{ns.source}.{n}")
    for n, df in _target_tables(spark, sf).items():
        if n != "events":
            df.write.format("parquet").saveAsTable(f"{ns.target}.{n}")
    return AU.reconcile_counts(AU.table_counts_in(spark, ns.source), AU.table_counts_in(spark, ns.target))


@recipe("audit_append", f"""
SELECT {_lit_ids()}, '' AS AMT_COL_SRC, '0' AS TTL_AMT_SRC, '0' AS TTL_REC_SRC, '' AS AMT_COL_TGT,
       '0' AS TTL_AMT_TGT, '0' AS TTL_REC_TGT, pos_dt AS POS_DT, '{IDS['started']}' AS STRT_TMS,
       '9999-12-31 23:59:59' AS END_TMS
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS pos_dt FROM orders)
UNION ALL {MEASURE_SQL}
""")
def q_audit_append(spark, sf):
    """Open and measured records appended to the shared audit table, and read back."""
    name = f"{scratch_database(spark)}.job_rcncl"
    K.empty_table(spark, AU.AUDIT_COLUMNS).write.format("parquet").saveAsTable(name)
    K.append_with_retry(AU.audit_open(_positions(spark, sf), **IDS), name)
    K.append_with_retry(_measure(spark, sf), name)
    return spark.table(name)


@recipe("snk_empty_table", "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, 'string' AS data_type, "
    f"(SELECT count(DISTINCT strftime(o_orderdate, '%Y')) FROM orders) AS non_nulls"
    for i, c in enumerate(AU.AUDIT_COLUMNS)))
def q_snk_empty_table(spark, sf):
    db = scratch_database(spark)
    name = f"{db}.job_rcncl"
    K.empty_table(spark, AU.AUDIT_COLUMNS).write.format("parquet").saveAsTable(name)
    K.append_with_retry(_measure(spark, sf), name)
    return K.column_inventory(spark.table(name))


# ------------------------------------------------------------ inventories

def part_inventories(spark, sf):
    """Two column inventories derived from ``part`` that exercise every rule (a table per
    brand and thousand of parts, so their number grows with the data):
    brand 1 is missing from the output, sizes 2-4 lose their column, sizes 5-7
    change type, brand 2 loses its partitioning, size 50 adds a column, and
    brand 25 is a view (column rules skipped)."""
    p = table(spark, sf, "part")
    tname = F.concat(F.lit("brand_"), F.regexp_extract("p_brand", "([0-9]+)$", 1), F.lit("_"),
                     F.floor(F.col("p_partkey") / 1000).cast("string"))
    col = F.concat(F.lit("c"), F.col("p_partkey").cast("string"))
    obj = F.when(F.col("p_brand") == "Brand#25", "view").otherwise("table")
    src = p.select(tname.alias("table_name"), col.alias("column_name"),
                   F.lower("p_type").alias("data_type"), (F.col("p_size") == 1).alias("is_partition"),
                   obj.alias("object_type"))
    kept = p.filter((F.col("p_brand") != "Brand#1") & ~F.col("p_size").between(2, 4))
    out = kept.select(F.upper(tname).alias("table_name"), F.upper(col).alias("column_name"),
                      F.when(F.col("p_size").between(5, 7), F.concat(F.lower("p_type"), F.lit("_v2")))
                      .otherwise(F.lower("p_type")).alias("data_type"),
                      ((F.col("p_size") == 1) & (F.col("p_brand") != "Brand#2")).alias("is_partition"),
                      obj.alias("object_type"))
    extra = p.filter((F.col("p_size") == 50) & (F.col("p_brand") != "Brand#1")).select(
        tname.alias("table_name"), F.concat(col, F.lit("_x")).alias("column_name"),
        F.lit("string").alias("data_type"), F.lit(False).alias("is_partition"),
        obj.alias("object_type"))
    return src, out.unionByName(extra)


@recipe("inventory_diff", """
WITH p AS (SELECT *, 'brand_' || regexp_extract(p_brand, '([0-9]+)$', 1) || '_'
                     || CAST(p_partkey // 1000 AS VARCHAR) AS t, 'c' || CAST(p_partkey AS VARCHAR) AS c,
                  CASE WHEN p_brand = 'Brand#25' THEN 'view' ELSE 'table' END AS o FROM part),
s AS (SELECT t, c, lower(p_type) AS ty, p_size = 1 AS isp, o FROM p),
ot AS (SELECT t, c, CASE WHEN p_size BETWEEN 5 AND 7 THEN lower(p_type) || '_v2' ELSE lower(p_type) END AS ty,
              p_size = 1 AND p_brand <> 'Brand#2' AS isp, o
       FROM p WHERE p_brand <> 'Brand#1' AND NOT (p_size BETWEEN 2 AND 4)
       UNION ALL
       SELECT t, c || '_x', 'string', false, o FROM p WHERE p_size = 50 AND p_brand <> 'Brand#1'),
st AS (SELECT t, max(o) AS o, max(CAST(isp AS INTEGER)) AS sp FROM s GROUP BY t),
otb AS (SELECT t, max(CAST(isp AS INTEGER)) AS op FROM ot GROUP BY t),
both_t AS (SELECT st.t, st.sp, otb.op FROM st JOIN otb ON st.t = otb.t WHERE st.o = 'table'),
cols AS (SELECT coalesce(a.t, b.t) AS t, coalesce(a.c, b.c) AS c, a.ty AS sty, b.ty AS oty
         FROM (SELECT * FROM s WHERE t IN (SELECT t FROM both_t)) a
         FULL JOIN (SELECT * FROM ot WHERE t IN (SELECT t FROM both_t)) b ON a.t = b.t AND a.c = b.c)
SELECT 'error' AS severity, t AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       'missing_table' AS issue, o AS detail FROM st WHERE t NOT IN (SELECT t FROM otb)
UNION ALL
SELECT 'warning', t, NULL, 'partition_dropped', NULL FROM both_t WHERE sp = 1 AND op = 0
UNION ALL
SELECT CASE WHEN oty IS NULL THEN 'error' ELSE 'warning' END, t, c,
       CASE WHEN oty IS NULL THEN 'missing_column' WHEN sty IS NULL THEN 'extra_column'
            ELSE 'type_changed' END,
       CASE WHEN oty IS NOT NULL AND sty IS NOT NULL THEN sty || ' -> ' || oty END
FROM cols WHERE oty IS NULL OR sty IS NULL OR sty <> oty
""")
def q_inventory_diff(spark, sf):
    src, out = part_inventories(spark, sf)
    return AU.diff_inventory(src, out)


# ------------------------------------------------------------ drill-down

SWAPPED_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
q AS (SELECT a.o_orderkey, b.o_totalprice AS price FROM o a JOIN o b ON b.o_orderkey = xor(a.o_orderkey, 1)
      WHERE a.o_orderkey // 2 % 50 = 0)
"""


@recipe("reconcile_rows", f"""
{SWAPPED_SQL}
SELECT o.o_orderkey, 'changed' AS status, 'o_totalprice' AS columns FROM o JOIN q USING (o_orderkey)
WHERE price <> o_totalprice AND o.o_orderkey % 1000 <> 7
UNION ALL SELECT o_orderkey, 'missing', NULL FROM o WHERE o_orderkey % 1000 = 7
UNION ALL SELECT -o_orderkey, 'extra', NULL FROM o WHERE o_orderkey % 1000 = 7
""")
def q_reconcile_rows(spark, sf):
    """Two images with equal counts: amounts of some orders swapped in pairs, some orders under another key."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    swapped = o.filter("o_orderkey div 2 % 50 = 0").select(
        F.col("o_orderkey").bitwiseXOR(1).alias("k"), F.col("o_totalprice").alias("price"))
    image = o.join(swapped, F.col("o_orderkey") == F.col("k"), "left").select(
        F.when(F.col("o_orderkey") % 1000 == 7, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey", F.coalesce("price", "o_totalprice").alias("o_totalprice"), "o_orderpriority")
    base = scratch_path(spark, "images")
    trees = []
    for name, df in (("source", o), ("target", image)):
        df.withColumn("leaf", AU.leaf_of(["o_orderkey"], 6)).repartition("leaf").write.partitionBy("leaf").parquet(f"{base}/{name}")
        AU.hash_tree(df, ["o_orderkey"], (2, 4, 6)).write.parquet(f"{base}/{name}-tree")
        trees.append(spark.read.parquet(f"{base}/{name}-tree"))
    leaves = AU.differing_leaves(*trees, bits=(2, 4, 6))
    source, target = (spark.read.parquet(f"{base}/{n}") for n in ("source", "target"))
    return AU.diff_images(source, target, leaves, ["o_orderkey"], (2, 4, 6), "leaf")


@recipe("audit_append_once", """
SELECT 'first' AS load, count(*) AS records FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)
UNION ALL SELECT 'second', count(*) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)
""")
def q_audit_append_once(spark, sf):
    """Audit records of two runs in the shared table; every append is sent again as if its answer had been lost."""
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("pos_dt")).distinct()
    path = scratch_path(spark, "audit-once")
    for run in ("first", "second", "first", "second"):
        append_once(AU.audit_open(days, **(IDS | {"job": run})), path, f"{run} run")
    return spark.read.parquet(path).groupBy(F.col("JOB_NM").alias("load")).agg(F.count(F.lit(1)).alias("records"))
