"""Queries for scalar functions, shaping, lookups, profiling and generic checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadworks.functions import scalar as S
from loadworks.operators import checks as C
from loadworks.operators import shaping as P
from loadworks.operators.joins import Lookup, enrich
from loadworks.plans.registry import ALL_TABLES, recipe, table

BUSINESS_DAY = "2024-01-15"


# ------------------------------------------------------------------ lookups

def enriched_orders(spark, sf):
    """orders ⟕ customer ⟕ nation ⟕ region; the customer lookup is doubled
    on purpose: dedupe keeps the row count of orders."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    doubled = customer.unionByName(customer)
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    out = enrich(orders, [
        Lookup(doubled, {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey", "c_mktsegment"]),
        Lookup(nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
        Lookup(region, {"n_regionkey": "r_regionkey"}, ["r_name"]),
    ])
    return out.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "c_name",
                      "c_nationkey", "c_mktsegment", "n_name", "n_regionkey", "r_name")


ENRICH_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_nationkey,
       c.c_mktsegment, n.n_name, n.n_regionkey, r.r_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@recipe("enrich_lookups", ENRICH_SQL)
def q_enrich_lookups(spark, sf):
    return enriched_orders(spark, sf)


def _documents_enriched(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels")
    # A lookup that can never match (negative keys) and one that always does.
    never = table(spark, sf, "customer").select((-F.col("c_custkey") - 1).alias("k"),
                                                F.col("c_name").alias("never_name"))
    langs = table(spark, sf, "documents").select("lang", F.upper("lang").alias("lang_code"))
    target = enrich(docs, [
        Lookup(labels, ["doc_id"], ["quality", "toxic"]),
        Lookup(never, {"doc_id": "k"}, ["never_name"]),
        Lookup(langs, ["lang"], ["lang_code"]),
    ])
    return docs, target


CHECK_MULTI_JOIN_SQL = """
WITH t AS (
  SELECT d.doc_id, l.quality, x.never_name, g.lang_code
  FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id
  LEFT JOIN (SELECT -c_custkey - 1 AS k, c_name AS never_name FROM customer) x ON d.doc_id = x.k
  LEFT JOIN (SELECT DISTINCT lang, upper(lang) AS lang_code FROM documents) g ON d.lang = g.lang),
a AS (
  SELECT (SELECT count(*) FROM documents) AS main_rows, count(*) AS target_rows,
         count(*) FILTER (WHERE quality IS NULL) AS n0,
         count(*) FILTER (WHERE never_name IS NULL) AS n1,
         count(*) FILTER (WHERE lang_code IS NULL) AS n2
  FROM t),
p AS (
  SELECT *, CAST(((n0 * 20000 + target_rows) // (2 * target_rows)) / 100 AS DECIMAL(20,2)) AS p0,
            CAST(((n1 * 20000 + target_rows) // (2 * target_rows)) / 100 AS DECIMAL(20,2)) AS p1,
            CAST(((n2 * 20000 + target_rows) // (2 * target_rows)) / 100 AS DECIMAL(20,2)) AS p2
  FROM a)
SELECT 'Row count match' AS check_name,
       CASE WHEN target_rows = main_rows THEN 'PASS' ELSE 'WARN' END AS status,
       CASE WHEN target_rows <> main_rows THEN 'diff=' || CAST(target_rows - main_rows AS VARCHAR) END AS detail,
       CAST(target_rows - main_rows AS DECIMAL(20,2)) AS measure FROM p
UNION ALL
SELECT 'Lookup quality', CASE WHEN n0 = target_rows THEN 'FAIL' WHEN n0 * 2 > target_rows THEN 'WARN' ELSE 'PASS' END,
       CAST(p0 AS VARCHAR) || '% NULL', p0 FROM p
UNION ALL
SELECT 'Lookup never_name', CASE WHEN n1 = target_rows THEN 'FAIL' WHEN n1 * 2 > target_rows THEN 'WARN' ELSE 'PASS' END,
       CAST(p1 AS VARCHAR) || '% NULL', p1 FROM p
UNION ALL
SELECT 'Lookup lang_code', CASE WHEN n2 = target_rows THEN 'FAIL' WHEN n2 * 2 > target_rows THEN 'WARN' ELSE 'PASS' END,
       CAST(p2 AS VARCHAR) || '% NULL', p2 FROM p
UNION ALL
SELECT 'Audit col lang', 'PASS', NULL, NULL
UNION ALL
SELECT 'Audit col load_ts', 'FAIL', 'missing from target', NULL
"""


@recipe("check_multi_join", CHECK_MULTI_JOIN_SQL)
def q_check_multi_join(spark, sf):
    docs, target = _documents_enriched(spark, sf)
    return C.check_multi_join(docs, target, ["quality", "never_name", "lang_code"],
                              ["lang", "load_ts"])


@recipe("null_profile", """
WITH t AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT count(*) AS r, count(*) FILTER (WHERE doc_id IS NULL) AS n_doc_id,
             count(*) FILTER (WHERE lang IS NULL) AS n_lang,
             count(*) FILTER (WHERE source IS NULL) AS n_source,
             count(*) FILTER (WHERE quality IS NULL) AS n_quality,
             count(*) FILTER (WHERE toxic IS NULL) AS n_toxic FROM t),
u AS (SELECT 'doc_id' AS column_name, n_doc_id AS nulls, r AS row_count FROM c
      UNION ALL SELECT 'lang', n_lang, r FROM c
      UNION ALL SELECT 'source', n_source, r FROM c
      UNION ALL SELECT 'quality', n_quality, r FROM c
      UNION ALL SELECT 'toxic', n_toxic, r FROM c)
SELECT column_name, nulls, row_count,
       CASE WHEN row_count > 0 THEN CAST(((nulls * 20000 + row_count) // (2 * row_count)) / 100 AS DECIMAL(20,2))
            ELSE CAST(0 AS DECIMAL(20,2)) END AS null_pct
FROM u
""")
def q_null_profile(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return C.null_profile(joined.select("doc_id", "lang", "source", "quality", "toxic"))


# ------------------------------------------------------------------ scalars

@recipe("scalar_functions", """
WITH fo AS (SELECT o_custkey, arg_min(o_orderdate, o_orderkey) AS o_orderdate,
                   arg_min(o_totalprice, o_orderkey) AS o_totalprice
            FROM orders GROUP BY o_custkey),
b AS (SELECT c.*, fo.o_orderdate, fo.o_totalprice,
             CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_nationkey END AS maybe_nation,
             CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment END AS maybe_segment
      FROM customer c LEFT JOIN fo ON c.c_custkey = fo.o_custkey)
SELECT c_custkey,
  trim('  ' || c_name || '  ') AS name_trim,
  ltrim('  ' || c_mktsegment) AS seg_ltrim,
  rtrim(c_mktsegment || '  ') AS seg_rtrim,
  regexp_replace(c_name, '[0-9]+', 'N', 'g') AS name_ereplace,
  coalesce(maybe_nation, 0) AS nation_or_zero,
  coalesce(maybe_segment, '') AS segment_or_empty,
  maybe_nation IS NULL AS nation_is_null,
  maybe_nation IS NOT NULL AS nation_is_not_null,
  CASE WHEN maybe_nation IS NOT NULL THEN maybe_nation ELSE -1 END AS nation_if_not_null,
  CASE WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'LOW' END AS bal_band,
  sha256(c_name) AS name_sha256,
  substring('4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0'), 1, 6) || '******'
    || substring('4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0'), 13, 4) AS card_masked,
  md5(c_name) AS name_md5,
  left(c_name, 8) AS name_left8,
  right(c_name, 4) AS name_right4,
  substring(c_name, 1, 4) || substring(c_name, 10, 3) AS name_parts,
  TIMESTAMP '2024-01-15 00:00:00' AS run_ts,
  DATE '2024-01-15' AS run_date,
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS bal_text,
  TRY_CAST(CAST(c_nationkey AS VARCHAR) || '.5' AS DECIMAL(38,10)) AS nation_decimal,
  TRY_CAST(c_mktsegment AS DECIMAL(38,10)) AS segment_decimal,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_text,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 13 MONTH AS DATE) + 3 AS order_plus,
  c_name || '-' || maybe_segment AS name_concat,
  TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) AS nation_int,
  TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS price_dec,
  pow(c_nationkey, 2) AS nation_pow,
  CAST(NULL AS VARCHAR) AS null_text,
  upper(c_mktsegment) AS seg_upper,
  lower(c_mktsegment) AS seg_lower,
  length(c_name) AS name_length,
  CAST(o_orderdate AS DATE) AS first_order_date,
  nullif(CASE WHEN c_acctbal < 1000 THEN 'NULL' ELSE c_mktsegment END, 'NULL') AS seg_nullif
FROM b
""")
def q_scalar_functions(spark, sf):
    customer = table(spark, sf, "customer")
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(F.struct("o_orderkey", "o_orderdate", "o_totalprice")).alias("fo"))
    b = customer.join(first, customer.c_custkey == first.o_custkey, "left").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.col("fo.o_orderdate").alias("o_orderdate"), F.col("fo.o_totalprice").alias("o_totalprice"),
        F.when(F.col("c_acctbal") < 1000, None).otherwise(F.col("c_nationkey")).alias("maybe_nation"),
        F.when(F.col("c_acctbal") < 1000, None).otherwise(F.col("c_mktsegment")).alias("maybe_segment"))
    account = F.concat(F.lit("4"), F.lpad(F.col("c_custkey").cast("string"), 15, "0"))
    return b.select(
        "c_custkey",
        S.trim_spaces(F.concat(F.lit("  "), "c_name", F.lit("  "))).alias("name_trim"),
        S.trim_leading(F.concat(F.lit("  "), "c_mktsegment")).alias("seg_ltrim"),
        S.trim_trailing(F.concat("c_mktsegment", F.lit("  "))).alias("seg_rtrim"),
        S.ereplace("c_name", "[0-9]+", "N").alias("name_ereplace"),
        S.null_to_zero("maybe_nation").alias("nation_or_zero"),
        S.null_to_empty("maybe_segment").alias("segment_or_empty"),
        S.is_null("maybe_nation").alias("nation_is_null"),
        S.is_not_null("maybe_nation").alias("nation_is_not_null"),
        S.if_not_null("maybe_nation", -1).alias("nation_if_not_null"),
        S.iif(F.col("c_acctbal") > 5000, "HIGH", "LOW").alias("bal_band"),
        S.hash_sha256("c_name").alias("name_sha256"),
        S.card_mask(account).alias("card_masked"),
        S.md5_hex("c_name").alias("name_md5"),
        S.str_left("c_name", 8).alias("name_left8"),
        S.str_right("c_name", 4).alias("name_right4"),
        F.concat(S.substrings("c_name", 1, 4), S.substrings("c_name", 10, 3)).alias("name_parts"),
        S.timestamp_from_date_param(BUSINESS_DAY).alias("run_ts"),
        S.current_dt(BUSINESS_DAY).alias("run_date"),
        S.decimal_to_string(F.col("c_acctbal").cast("decimal(12,2)")).alias("bal_text"),
        S.string_to_decimal(F.concat(F.col("c_nationkey").cast("string"), F.lit(".5")))
        .alias("nation_decimal"),
        S.string_to_decimal("c_mktsegment").alias("segment_decimal"),
        S.date_to_string("o_orderdate", "YYYY-MM-DD %hh:%nn:%ss").alias("order_text"),
        S.date_offset_by_components("o_orderdate", 1, 1, 3).alias("order_plus"),
        S.concat_op("c_name", F.lit("-"), "maybe_segment").alias("name_concat"),
        S.to_int(F.col("c_nationkey").cast("string")).alias("nation_int"),
        S.to_decimal("o_totalprice", 10, 2).alias("price_dec"),
        S.power("c_nationkey", 2).alias("nation_pow"),
        S.null_of("string").alias("null_text"),
        F.upper("c_mktsegment").alias("seg_upper"),
        F.lower("c_mktsegment").alias("seg_lower"),
        F.length("c_name").alias("name_length"),
        F.to_date("o_orderdate").alias("first_order_date"),
        S.null_if_text_null(F.when(F.col("c_acctbal") < 1000, F.lit("NULL"))
                            .otherwise(F.col("c_mktsegment"))).alias("seg_nullif"),
    )


# ------------------------------------------------------------------ shaping

ORDER_TARGET = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]


@recipe("prj_target_order", "SELECT " + ", ".join(ORDER_TARGET) + " FROM orders")
def q_prj_target_order(spark, sf):
    o = table(spark, sf, "orders")
    shuffled = o.select("o_orderpriority", "o_totalprice", "o_orderkey", "o_custkey",
                        F.lit("x").alias("extra_col"), "o_orderdate", "o_orderstatus")
    return P.project_to(shuffled, ORDER_TARGET)


@recipe("prj_common_columns",
        "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def q_prj_common_columns(spark, sf):
    c = table(spark, sf, "customer")
    upper = c.select(*[F.col(x).alias(x.upper()) for x in c.columns], F.lit(1).alias("EXTRA"))
    return P.project_common(upper, ["c_custkey", "c_name", "c_acctbal", "c_unknown",
                                    "c_mktsegment"])


@recipe("prj_rename_and_pad", """
SELECT s_suppkey AS supp_id, s_name AS supp_name, s_nationkey AS nation_id,
       s_acctbal AS acct_balance, CAST(NULL AS VARCHAR) AS region_code,
       CAST(NULL AS VARCHAR) AS load_batch
FROM supplier
""")
def q_prj_rename_and_pad(spark, sf):
    s = table(spark, sf, "supplier")
    dotted = s.select(*[F.col(c).alias(f"aa.{c}") for c in s.columns])
    return P.derive_table(
        dotted,
        {"S_SUPPKEY": "supp_id", "S_NAME": "supp_name", "S_NATIONKEY": "nation_id",
         "S_ACCTBAL": "acct_balance"},
        ["supp_id", "supp_name", "acct_balance", "region_code", "load_batch"])


@recipe("prj_cast_all_string", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS p_retailprice
FROM part
""")
def q_prj_cast_all_string(spark, sf):
    p = table(spark, sf, "part")
    p = p.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))
    return P.cast_all_string(p)


@recipe("prj_partition_columns", """
SELECT strftime(o_orderdate, '%Y') AS ptn_yyyy, strftime(o_orderdate, '%m') AS ptn_mm,
       count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount
FROM orders GROUP BY 1, 2
""")
def q_prj_partition_columns(spark, sf):
    o = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pos_dt"), "o_totalprice")
    return P.with_partition_columns(o, "pos_dt").groupBy("ptn_yyyy", "ptn_mm").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))


@recipe("flt_business_day", """
SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
""")
def q_flt_business_day(spark, sf):
    start = S.timestamp_from_date_param(BUSINESS_DAY)
    ev = table(spark, sf, "events")
    return ev.filter((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))


@recipe("sample_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def q_sample_rows(spark, sf):
    return C.sample_rows(table(spark, sf, "customer"), 5, ["c_custkey"])


@recipe("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES))
def q_table_counts(spark, sf):
    return C.table_counts({t: table(spark, sf, t) for t in ALL_TABLES})


def _generic_tables(spark, sf):
    tabs = {t: table(spark, sf, t) for t in ALL_TABLES}
    tabs["empty_orders"] = tabs["orders"].filter(F.col("o_totalprice") < 0)
    return tabs


def _generic_sql():
    parts = []
    for t in ALL_TABLES + ["empty_orders"]:
        src = "(SELECT * FROM orders WHERE o_totalprice < 0)" if t == "empty_orders" else t
        parts.append(
            f"SELECT '{t} has rows' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END "
            f"AS status, CAST(count(*) AS VARCHAR) || ' rows' AS detail, "
            f"CAST(count(*) AS DECIMAL(20,2)) AS measure FROM {src}")
    return parts


_NCOLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
          "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
          "benchmark": 2, "labels": 3, "conversations": 4, "empty_orders": 6}


def _generic_schema_sql():
    return [f"SELECT '{t} schema non-empty', 'PASS', '{n} columns', CAST({n} AS DECIMAL(20,2))"
            for t, n in _NCOLS.items()]


GENERIC_SQL = "\nUNION ALL\n".join(_generic_sql() + _generic_schema_sql())


SAMPLED = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
           "labels": ["doc_id", "quality", "toxic"], "benchmark": ["item_id", "text"]}


@recipe("check_generic_samples", "\nUNION ALL\n".join(
    "SELECT * FROM (SELECT '" + t + "' AS table_name, CAST(to_json({"
    + ", ".join(f"'{c}': {c}" for c in cols) + f"}}) AS VARCHAR) AS sample FROM {t} ORDER BY sample LIMIT 5) x"
    for t, cols in SAMPLED.items()))
def q_check_generic_samples(spark, sf):
    return C.generic_samples({t: table(spark, sf, t) for t in SAMPLED})


@recipe("check_generic", GENERIC_SQL)
def q_check_generic(spark, sf):
    return C.check_generic(_generic_tables(spark, sf))


@recipe("partition_values", "SELECT DISTINCT l_returnflag FROM lineitem")
def q_partition_values(spark, sf):
    return C.partition_values(table(spark, sf, "lineitem"), "l_returnflag")


@recipe("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_duplicate_keys(spark, sf):
    return C.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
