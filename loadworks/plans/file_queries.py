"""Queries over landed files.

Each recipe first lands files derived from the test tables in a fresh folder
below the session's shared checkpoint folder, then reads them back with the
library's distributed file operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.operators import checks as C
from loadworks.operators import shaping as P
from loadworks.plans.registry import recipe, table
from loadworks.session import scratch_path
from loadworks.sources import files as FS


LAND_ROWS = 10_000  # lines of a landed file, about: the number of files grows with the data
# Database prefixes stripped from landed file names.
PREFIXES = ["datalake.", "datatank.", "common_layer.", "datatank_view."]


def numbered_files(body: DataFrame, group: str, key: str) -> DataFrame:
    """Deals the rows of each group to files of about LAND_ROWS rows: adds ``file_no``."""
    files = body.groupBy(group).agg(F.ceil(F.count("*") / LAND_ROWS).alias("files"))
    return body.join(files, group).withColumn("file_no", F.pmod(F.col(key), F.col("files"))).drop("files")


def land_lines(lines: DataFrame, path: str, *part_cols: str) -> str:
    """Write ``(part_cols, ord, value)`` rows as one text file per combination of the
    partition values, lines in ``ord`` order."""
    lines.repartition(*part_cols).sortWithinPartitions(*part_cols, "ord") \
        .select(*part_cols, "value").write.partitionBy(*part_cols).text(path)
    return path


def _part_value(file_col, name: str):
    return F.url_decode(F.regexp_extract(file_col, f"{name}=([^/]+)", 1))


# ------------------------------------------------------------ region files

def _customer_fields(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_regionkey").alias("region"), "c_custkey",
        F.col("c_custkey").cast("string").alias("f1"), F.col("c_name").alias("f2"),
        F.col("c_nationkey").cast("string").alias("f3"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("f4"),
        F.col("c_mktsegment").alias("f5"))


def _land_separator_files(spark, sf) -> str:
    """Region 0..4 written with SOH, pipe, tab, comma, and pipe/comma mixed."""
    rows = _customer_fields(spark, sf)
    sep = F.when(F.col("region") == 0, "\x01").when(F.col("region") == 1, "|") \
        .when(F.col("region") == 2, "\t").otherwise(",")
    joined = F.regexp_replace(F.concat_ws("\x02", "f1", "f2", "f3", "f4", "f5"), "\x02", sep)
    # comma first: wherever the prefix ends, it has as many commas as pipes or one more
    mixed = F.concat_ws("", "f1", F.lit(","), "f2", F.lit("|"), "f3", F.lit(","), "f4",
                        F.lit("|"), "f5")
    lines = rows.select("region", F.col("c_custkey").alias("ord"),
                        F.when(F.col("region") == 4, mixed).otherwise(joined).alias("value"))
    return land_lines(numbered_files(lines, "region", "ord"), scratch_path(spark, "sep"), "region", "file_no")


REGION_SQL = "SELECT DISTINCT n_regionkey AS region FROM customer JOIN nation ON c_nationkey = n_nationkey"


@recipe("src_sniff_delimiter", f"""
SELECT region, CASE region WHEN 0 THEN 'soh' WHEN 1 THEN 'pipe' WHEN 2 THEN 'tab'
                           ELSE 'comma' END AS delimiter
FROM ({REGION_SQL}) r
""")
def q_src_sniff_delimiter(spark, sf):
    path = _land_separator_files(spark, sf)
    found = FS.sniff_delimiter(spark, path)
    return found.select(_part_value(F.col("file"), "region").cast("int").alias("region"),
                        "delimiter").distinct()


@recipe("src_sniff_width", f"""
SELECT region, CASE region WHEN 2 THEN 'tab' WHEN 3 THEN 'comma' ELSE 'pipe' END AS delimiter
FROM ({REGION_SQL}) r
""")
def q_src_sniff_width(spark, sf):
    path = _land_separator_files(spark, sf)
    found = FS.sniff_delimiter_by_width(FS.head_lines(spark, path, FS.WIDTH_LINES[1]))
    return found.select(_part_value(F.col("file"), "region").cast("int").alias("region"),
                        "delimiter").distinct()


@recipe("src_header_flag", f"SELECT region, region % 2 = 0 AS has_header FROM ({REGION_SQL}) r")
def q_src_header_flag(spark, sf):
    rows = _customer_fields(spark, sf)
    data = rows.select("region", (F.col("c_custkey") + 1).alias("ord"),
                       F.concat_ws("|", "f1", "f2", "f3", "f4", "f5").alias("value"))
    data = numbered_files(data, "region", "ord")
    header = data.filter(F.col("region") % 2 == 0).select("region", "file_no").distinct().select(
        "region", F.lit(0).cast("long").alias("ord"),
        F.lit("c_custkey|c_name|c_nationkey|c_acctbal|c_mktsegment").alias("value"), "file_no")
    path = land_lines(header.unionByName(data), scratch_path(spark, "hdr"), "region", "file_no")
    flags = FS.header_flags(FS.head_lines(spark, path, 1), "|")
    return flags.select(_part_value(F.col("file"), "region").cast("int").alias("region"),
                        "has_header").distinct()


@recipe("src_delimited", "SELECT * FROM supplier")
def q_src_delimited(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "supplier").write.option("sep", "|").option("header", "true").csv(path)
    df = FS.read_delimited(spark, path, sep="|", header=True, infer=True)
    return df.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name",
                     F.col("s_nationkey").cast("int").alias("s_nationkey"),
                     F.col("s_acctbal").cast("double").alias("s_acctbal"))


@recipe("src_table_name", """
WITH p AS (SELECT p_partkey, '/landing/' ||
             CASE p_partkey % 4 WHEN 0 THEN 'DataLake.' WHEN 1 THEN 'datatank.'
                                WHEN 2 THEN 'Common_Layer.' ELSE '' END
             || replace(p_name, ' ', '-') || '.csv' AS path FROM part),
s AS (SELECT p_partkey, lower(regexp_extract(path, '([^/]*)\\.[^./]*$', 1)) AS stem FROM p)
SELECT p_partkey,
  translate(CASE WHEN starts_with(stem, 'datalake.') THEN substring(stem, 10)
                 WHEN starts_with(stem, 'datatank.') THEN substring(stem, 10)
                 WHEN starts_with(stem, 'common_layer.') THEN substring(stem, 14)
                 WHEN starts_with(stem, 'datatank_view.') THEN substring(stem, 15)
                 ELSE stem END, '- .', '___') AS table_name
FROM s
""")
def q_src_table_name(spark, sf):
    p = table(spark, sf, "part")
    prefix = F.when(F.col("p_partkey") % 4 == 0, "DataLake.") \
        .when(F.col("p_partkey") % 4 == 1, "datatank.") \
        .when(F.col("p_partkey") % 4 == 2, "Common_Layer.").otherwise("")
    path = F.concat(F.lit("/landing/"), prefix, F.replace("p_name", F.lit(" "), F.lit("-")),
                    F.lit(".csv"))
    return p.select("p_partkey", FS.table_name_from_path(path, PREFIXES).alias("table_name"))


@recipe("src_business_date", """
SELECT DISTINCT 'X.D' || strftime(o_orderdate, '%d%m%y') AS path,
       make_date(2000 + CAST(strftime(o_orderdate, '%y') AS INTEGER),
                 CAST(strftime(o_orderdate, '%m') AS INTEGER),
                 CAST(strftime(o_orderdate, '%d') AS INTEGER)) AS business_date
FROM orders
""")
def q_src_business_date(spark, sf):
    paths = table(spark, sf, "orders").select(
        FS.path_for_business_date(F.lit("X"), F.col("o_orderdate")).alias("path")).distinct()
    return paths.select("path", FS.business_date_from_path(F.col("path")).alias("business_date"))


# ------------------------------------------------------------ flat files

FLAT_COLS = ["org", "order_key", "pos_date", "amount"]


def _land_flat_files(spark, sf, corrupt: bool = False) -> str:
    """Files per order priority: header, detail records, trailer count."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("prio"), "o_orderkey", "o_totalprice",
        F.concat_ws("|", F.lit("001"), F.col("o_orderkey").cast("string"),
                    F.date_format("o_orderdate", "yyyy-MM-dd"),
                    F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("rec"))
    if corrupt:
        o = o.withColumn("rec", F.when((F.col("prio") == "3-MEDIUM") & (F.col("o_totalprice") > 499000),
                                       F.concat("rec", F.lit("|extra"))).otherwise(F.col("rec")))
    o = numbered_files(o, "prio", "o_orderkey")
    files = ["prio", "file_no"]
    details = o.select(*files, (F.col("o_orderkey") + 1).alias("ord"), F.col("rec").alias("value"))
    counts = o.groupBy(*files).agg(F.count(F.lit(1)).alias("n"))
    bump = F.when(F.lit(corrupt) & (F.col("prio") == "2-HIGH"), 1).otherwise(0)
    header = counts.select(*files, F.lit(0).cast("long").alias("ord"), F.lit("000|HDR").alias("value"))
    trailer = counts.select(*files, F.lit(1 << 62).cast("long").alias("ord"),
                            F.concat(F.lit("000|"), (F.col("n") + bump).cast("string")).alias("value"))
    lines = header.unionByName(details).unionByName(trailer)
    return land_lines(lines, scratch_path(spark, "flat"), *files)


FILES_SQL = f"""
SELECT o.*, o_orderkey % CAST(ceil(n / {LAND_ROWS}.0) AS BIGINT) AS file_no
FROM orders o JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) c USING (o_orderpriority)
"""
FLAT_SQL = """
SELECT '001' AS org, CAST(o_orderkey AS VARCHAR) AS order_key,
       strftime(o_orderdate, '%Y-%m-%d') AS pos_date,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS amount FROM orders
"""


@recipe("src_flat_schema", FLAT_SQL + f"""
UNION ALL SELECT '000', 'HDR', NULL, NULL FROM (SELECT DISTINCT o_orderpriority, file_no FROM ({FILES_SQL}) f)
UNION ALL SELECT '000', CAST(count(*) AS VARCHAR), NULL, NULL FROM ({FILES_SQL}) f
          GROUP BY o_orderpriority, file_no
""")
def q_src_flat_schema(spark, sf):
    return FS.read_flat(spark, _land_flat_files(spark, sf), FLAT_COLS, "|").select(*FLAT_COLS)


@recipe("src_drop_control", FLAT_SQL)
def q_src_drop_control(spark, sf):
    raw = FS.read_flat(spark, _land_flat_files(spark, sf), FLAT_COLS, "|").select(*FLAT_COLS)
    return FS.drop_control_records(raw, "org")


@recipe("src_record_count", f"""
SELECT o_orderpriority AS priority, file_no, count(*) AS records FROM ({FILES_SQL}) f GROUP BY 1, 2
""")
def q_src_record_count(spark, sf):
    counts = FS.count_records(spark, _land_flat_files(spark, sf))
    return counts.select(_part_value(F.col("file"), "prio").alias("priority"),
                         _part_value(F.col("file"), "file_no").cast("long").alias("file_no"), "records")


@recipe("check_control_file", f"""
SELECT o_orderpriority AS priority, file_no, true AS has_control_records, count(*) AS detail_lines,
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM' AND o_totalprice > 499000) AS bad_width_lines,
       count(*) + CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS trailer_count,
       CASE WHEN count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM' AND o_totalprice > 499000) = 0
             AND o_orderpriority <> '2-HIGH' THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({FILES_SQL}) f GROUP BY o_orderpriority, file_no
""")
def q_check_control_file(spark, sf):
    res = C.check_control_files(spark, _land_flat_files(spark, sf, corrupt=True), "|", len(FLAT_COLS))
    return res.select(_part_value(F.col("file"), "prio").alias("priority"),
                      _part_value(F.col("file"), "file_no").cast("long").alias("file_no"),
                      *[c for c in res.columns if c != "file"])


_WIDE = "o_orderpriority = '3-MEDIUM' AND o_totalprice > 499000"


@recipe("src_flat_rejects", f"""
SELECT 'rejected' AS outcome, o_orderpriority AS priority, file_no, 5 AS fields, 'too many fields' AS reason,
       '001|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' ||
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || '|extra' AS line
FROM ({FILES_SQL}) f WHERE {_WIDE}
UNION ALL
SELECT 'read', o_orderpriority, file_no, NULL, NULL, CAST(o_orderkey AS VARCHAR) FROM ({FILES_SQL}) f
WHERE NOT ({_WIDE})
""")
def q_src_flat_rejects(spark, sf):
    """Detail rows that could be read, and the lines of another width that could not."""
    rows, rejects = FS.read_flat_checked(spark, _land_flat_files(spark, sf, corrupt=True), FLAT_COLS, "|")
    where = [_part_value(F.col("file"), "prio").alias("priority"),
             _part_value(F.col("file"), "file_no").cast("long").alias("file_no")]
    good = FS.drop_control_records(rows, "org").select(
        F.lit("read").alias("outcome"), *where, F.lit(None).cast("int").alias("fields"),
        F.lit(None).cast("string").alias("reason"), F.col("order_key").alias("line"))
    return good.unionByName(rejects.select(F.lit("rejected").alias("outcome"), *where, "fields", "reason", "line"))


@recipe("flat_file_record_map", """
WITH r AS (SELECT '001' AS org, '4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS acct,
                  CASE WHEN c_custkey % 2 = 0
                       THEN '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')
                       WHEN c_custkey % 10 = 5 THEN '2024-13-01' ELSE '' END AS posting,
                  CAST(c_nationkey AS VARCHAR) AS seq, c_name FROM customer)
SELECT org AS ORG_CD, substring(acct, 1, 6) || '******' || substring(acct, 13, 4) AS ACCOUNT_MASK,
       sha256(acct) AS ACCOUNT_HASH,
       CASE WHEN posting = '' THEN NULL
            ELSE try_strptime(posting || ' 00:00:00', '%Y-%m-%d %H:%M:%S') END AS POSTING_TS,
       TRY_CAST(seq AS INTEGER) AS SEQ, c_name AS CUST_NM, 'SYS01' AS SOURCE_ID,
       TIMESTAMP '2024-01-15 06:00:00' AS LOAD_TS
FROM r
""")
def q_flat_file_record_map(spark, sf):
    c = table(spark, sf, "customer")
    account = F.concat(F.lit("4"), F.lpad(F.col("c_custkey").cast("string"), 15, "0"))
    posting = F.when(F.col("c_custkey") % 2 == 0,
                     F.concat(F.lit("2024-01-"),
                              F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"))) \
        .when(F.col("c_custkey") % 10 == 5, F.lit("2024-13-01")).otherwise(F.lit(""))
    rec = F.concat_ws("|", F.lit("001"), account, posting, F.col("c_nationkey").cast("string"),
                      F.col("c_name"))
    body = numbered_files(c.select(F.lit("all").alias("f"), (F.col("c_custkey") + 1).alias("ord"),
                                   rec.alias("value")), "f", "ord").drop("f")
    ctl = body.select("file_no").distinct()
    lines = ctl.select("file_no", F.lit(0).cast("long").alias("ord"), F.lit("000|HDR").alias("value")) \
        .unionByName(body.select("file_no", "ord", "value"))
    path = land_lines(lines, scratch_path(spark, "mf"), "file_no")
    raw = FS.read_flat(spark, path, ["ORG", "ACCT_NO", "POSTING_DTE", "SEQ_NO", "CUST_NM"], "|") \
        .select("ORG", "ACCT_NO", "POSTING_DTE", "SEQ_NO", "CUST_NM")
    spec = [P.FieldRule("ORG_CD", "copy", "ORG"),
            P.FieldRule("ACCOUNT_MASK", "mask", "ACCT_NO"),
            P.FieldRule("ACCOUNT_HASH", "hash", "ACCT_NO"),
            P.FieldRule("POSTING_TS", "timestamp", "POSTING_DTE"),
            P.FieldRule("SEQ", "int", "SEQ_NO"),
            P.FieldRule("CUST_NM", "copy", "CUST_NM"),
            P.FieldRule("SOURCE_ID", "const", value="SYS01"),
            P.FieldRule("LOAD_TS", "run_ts")]
    return P.map_record(FS.drop_control_records(raw, "ORG"), spec, run_ts="2024-01-15 06:00:00")
