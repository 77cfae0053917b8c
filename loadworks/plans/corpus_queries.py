"""Queries for corpus rule scans, statement checks and text volume.

``documents`` and ``conversations`` are scanned as they are.  The script
corpus for the statement checks is generated from ``orders`` (one script per
customer, one statement per order, kind chosen by the order's priority), so
its size grows with the data; the "converted" side rewrites, drops and merges
statements the way a conversion would.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loadworks.operators import corpus as CO
from loadworks.plans.registry import recipe, table

# The rule catalogue used on the documents corpus.
DOC_RULES = [
    CO.Rule("mail_address", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "high",
            "personal data: e-mail address", hints=("@",)),
    CO.Rule("licence_line", r"(?i)licen[cs]e", "high", "licence text"),
    CO.Rule("secret_word", r"(?i)(password|secret|api[_-]?key|token)", "critical",
            "possible secret"),
    CO.Rule("repeated_marks", r"[!?.]{3,}", "high", "junk punctuation"),
    CO.Rule("sentence_break", r"\.\n[A-Z]", "critical", "sentence ends at a line break",
            multiline=True),
]


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "lang",
                                                F.col("text").alias("content"))


def _issues(spark, sf):
    return CO.scan_rules(_docs(spark, sf), DOC_RULES)


# Written out on its own, not built from DOC_RULES: a wrong rule must show.
SCAN_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n')) AS line,
                  generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS line_no
           FROM documents),
m AS (SELECT doc_id, string_split_regex(text, '(?ms)\.\n[A-Z]') AS parts,
             regexp_extract_all(text, '(?ms)\.\n[A-Z]') AS ms FROM documents),
mi AS (SELECT doc_id, parts, ms, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0)
SELECT doc_id, 'mail_address' AS rule, 'high' AS severity, line_no FROM l
WHERE regexp_matches(line, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')
UNION ALL
SELECT doc_id, 'licence_line', 'high', line_no FROM l WHERE regexp_matches(line, '(?i)licen[cs]e')
UNION ALL
SELECT doc_id, 'secret_word', 'critical', line_no FROM l
WHERE regexp_matches(line, '(?i)(password|secret|api[_-]?key|token)')
UNION ALL
SELECT doc_id, 'repeated_marks', 'high', line_no FROM l WHERE regexp_matches(line, '[!?.]{3,}')
UNION ALL
SELECT doc_id, 'sentence_break', 'critical',
       1 + list_sum(list_transform(list_slice(parts, 1, i), lambda p: length(p) - length(replace(p, chr(10), ''))))
         + i - 1
FROM mi
"""



@recipe("corpus_rule_scan", SCAN_SQL)
def q_corpus_rule_scan(spark, sf):
    return _issues(spark, sf)


@recipe("corpus_rule_table", """
WITH b AS (SELECT item_id, substring(text, 1, CASE WHEN item_id % 10 = 0 THEN 5 ELSE 30 END) AS literal, item_id % 3 = 0 AS strict
           FROM benchmark WHERE text IS NOT NULL AND position(chr(10) IN substring(text, 1, 30)) = 0),
l AS (SELECT doc_id, unnest(string_split_regex(text, '\\r?\\n')) AS line,
             generate_subscripts(string_split_regex(text, '\\r?\\n'), 1) AS line_no FROM documents)
SELECT doc_id, 'item ' || item_id AS rule, CASE WHEN strict THEN 'critical' ELSE 'high' END AS severity, line_no
FROM l JOIN b ON contains(line, literal) AND (NOT strict OR starts_with(line, literal))
""")
def q_corpus_rule_table(spark, sf):
    """A rule a benchmark item: its beginning (of a few rules only the first letters) occurs in a line."""
    b = table(spark, sf, "benchmark").filter(F.instr(F.substring("text", 1, 30), "\n") == 0)
    strict = F.col("item_id") % 3 == 0
    literal = F.when(F.col("item_id") % 10 == 0, F.substring("text", 1, 5)).otherwise(F.substring("text", 1, 30))
    rules = b.select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("rule"),
                     F.when(strict, "critical").otherwise("high").alias("severity"),
                     F.when(strict, F.concat(F.lit("^\\Q"), literal, F.lit("\\E"))).alias("pattern"), literal.alias("literal"))
    return CO.scan_rule_table(_docs(spark, sf), rules, ["doc_id"])


CLASSIFY_SQL = f"""
SELECT d.doc_id, coalesce(i.n, 0) AS issues, coalesce(i.c, 0) AS critical_issues,
       coalesce(i.h, 0) AS high_issues,
       CASE WHEN coalesce(i.n, 0) > 0 THEN 'broken' ELSE 'clean' END AS classification
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE severity = 'critical') AS c,
                                   count(*) FILTER (WHERE severity = 'high') AS h
                            FROM ({SCAN_SQL}) s GROUP BY doc_id) i
  ON d.doc_id = i.doc_id
"""


@recipe("corpus_classify", CLASSIFY_SQL)
def q_corpus_classify(spark, sf):
    return CO.classify_documents(_docs(spark, sf), DOC_RULES)


@recipe("corpus_rule_summary", f"""
SELECT (SELECT count(*) FROM ({CLASSIFY_SQL}) c) AS files,
       (SELECT count(*) FROM ({CLASSIFY_SQL}) c WHERE classification = 'clean') AS clean_files,
       (SELECT count(*) FROM ({CLASSIFY_SQL}) c WHERE classification = 'broken') AS broken_files,
       count(*) AS total_issues, count(*) FILTER (WHERE severity = 'critical') AS critical_issues,
       count(*) FILTER (WHERE severity = 'high') AS high_issues
FROM ({SCAN_SQL}) s
""")
def q_corpus_rule_summary(spark, sf):
    return CO.summarise_scan(CO.classify_documents(_docs(spark, sf), DOC_RULES))


MARKERS = [CO.MarkerRule("english", "all", ("the", "and")),
           CO.MarkerRule("german", "any", ("der", "und", "die")),
           CO.MarkerRule("long_french", "count_word", n=4, word="que")]


@recipe("corpus_marker_class", """
SELECT conv_id,
  CASE WHEN bool_or(contains(text, 'the')) AND bool_or(contains(text, 'and')) THEN 'english'
       WHEN bool_or(contains(text, 'der')) OR bool_or(contains(text, 'und'))
            OR bool_or(contains(text, 'die')) THEN 'german'
       WHEN count(*) > 4 AND bool_or(contains(upper(text), 'QUE')) THEN 'long_french'
       ELSE 'other' END AS label
FROM conversations GROUP BY conv_id
""")
def q_corpus_marker_class(spark, sf):
    conv = table(spark, sf, "conversations").select("conv_id", F.col("text").alias("content"))
    return CO.classify_by_markers(conv, "conv_id", MARKERS, "other")


@recipe("corpus_short_wrappers", """
WITH d AS (SELECT doc_id, source, text,
             CASE WHEN text = '' THEN 0
                  ELSE len(string_split_regex(text, '\\r?\\n'))
                       - CASE WHEN suffix(text, chr(10)) THEN 1 ELSE 0 END END AS lines
           FROM documents)
SELECT doc_id, lines,
       source IN ('src3') OR (lines < 20 AND contains(text, 'Licensed')) AS flagged,
       CASE WHEN source IN ('src3') THEN 'skip_list'
            WHEN lines < 20 AND contains(text, 'Licensed') THEN 'short_wrapper' END AS reason
FROM d
""")
def q_corpus_short_wrappers(spark, sf):
    return CO.flag_short_wrappers(_docs(spark, sf), "source", "Licensed", 20, ("src3",))


@recipe("token_estimate", """
SELECT lang, source, CAST(sum(length(text)) AS BIGINT) AS chars,
       CAST(greatest(1, sum(length(text)) // 4) AS BIGINT) AS tokens
FROM documents GROUP BY lang, source
""")
def q_token_estimate(spark, sf):
    return CO.token_estimate(_docs(spark, sf), ["lang", "source"])


# ------------------------------------------------------------ script corpus

def _statements(spark, sf):
    """Source and converted statements, one per order, scripts per customer."""
    return _written(table(spark, sf, "orders"))


def _written(orders, *also):
    """The statements of each row of ``orders``, beside its columns ``also``."""
    o = orders.select(
        F.col("o_custkey").alias("script_id"), F.col("o_orderkey").alias("stmt_no"),
        "o_orderpriority", F.lower("o_orderstatus").alias("st"), "o_orderkey", "o_custkey", *also)
    key, cust, st, prio = (F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                           F.col("st"), F.col("o_orderpriority"))
    src = F.when(prio == "1-URGENT", F.concat(F.lit("INSERT INTO sales.orders_"), st,
                                              F.lit(" SELECT * FROM stage.orders WHERE o_orderkey = "), key)) \
        .when(prio == "2-HIGH", F.concat(F.lit("UPDATE sales.customer SET c_mktsegment = 'X' "
                                               "WHERE c_custkey = "), cust)) \
        .when(prio == "3-MEDIUM", F.concat(F.lit("DELETE FROM sales.orders_f WHERE o_orderkey = "), key)) \
        .when(prio == "4-NOT SPECIFIED", F.lit("INVALIDATE METADATA sales.orders")) \
        .otherwise(F.concat(F.lit("SELECT count(*) FROM stage.orders_"), st,
                            F.lit(" o JOIN ref.calendar c ON o.o_orderdate = c.d")))
    out = F.when(prio == "1-URGENT", F.concat(F.lit("INSERT INTO main.sales.orders_"), st,
                                              F.lit(" SELECT * FROM main.stage.orders WHERE o_orderkey = "), key)) \
        .when((prio == "2-HIGH") & (st == "f"),
              F.concat(F.lit("MERGE INTO main.sales.customer t USING upd s ON t.c_custkey = "),
                       cust, F.lit(" WHEN MATCHED THEN UPDATE SET c_mktsegment = 'X'"))) \
        .when(prio == "2-HIGH", F.concat(F.lit("UPDATE main.sales.customer SET c_mktsegment = 'X' "
                                               "WHERE c_custkey = "), cust)) \
        .when((prio == "3-MEDIUM") & (st != "p"),
              F.concat(F.lit("DELETE FROM main.sales.orders_f WHERE o_orderkey = "), key)) \
        .when((prio == "5-LOW") & (st == "o"),
              F.concat(F.lit("SELECT count(*) FROM main.stage.orders_"), st, F.lit(" o")))  \
        .when(prio == "5-LOW", F.concat(F.lit("SELECT count(*) FROM main.stage.orders_"), st,
                                        F.lit(" o JOIN main.ref.calendar c ON o.o_orderdate = c.d")))
    extra = F.when((prio == "4-NOT SPECIFIED") & (st == "o"), F.lit("kinit -kt svc.keytab svc")) \
        .when((prio == "4-NOT SPECIFIED") & (st == "f"), F.lit("# kinit -kt svc.keytab svc")) \
        .when((prio == "4-NOT SPECIFIED") & (st == "p"), F.lit("\t// hdfs dfs -ls /landing")) \
        .when((prio == "5-LOW") & (st == "p"), F.lit("beeline -u jdbc:hive2://h -e 'select 1'"))
    return o.select("script_id", "stmt_no", src.alias("sql"), out.alias("out_sql"),
                    extra.alias("extra_line"), *also)


STMT_SQL = """
WITH o AS (SELECT o_custkey AS script_id, o_orderkey AS stmt_no, o_orderpriority AS prio,
                  lower(o_orderstatus) AS st, CAST(o_orderkey AS VARCHAR) AS k,
                  CAST(o_custkey AS VARCHAR) AS c FROM orders)
SELECT script_id, stmt_no,
  CASE WHEN prio = '1-URGENT' THEN 'INSERT INTO sales.orders_' || st || ' SELECT * FROM stage.orders WHERE o_orderkey = ' || k
       WHEN prio = '2-HIGH' THEN 'UPDATE sales.customer SET c_mktsegment = ''X'' WHERE c_custkey = ' || c
       WHEN prio = '3-MEDIUM' THEN 'DELETE FROM sales.orders_f WHERE o_orderkey = ' || k
       WHEN prio = '4-NOT SPECIFIED' THEN 'INVALIDATE METADATA sales.orders'
       ELSE 'SELECT count(*) FROM stage.orders_' || st || ' o JOIN ref.calendar c ON o.o_orderdate = c.d' END AS sql,
  CASE WHEN prio = '1-URGENT' THEN 'INSERT INTO main.sales.orders_' || st || ' SELECT * FROM main.stage.orders WHERE o_orderkey = ' || k
       WHEN prio = '2-HIGH' AND st = 'f' THEN 'MERGE INTO main.sales.customer t USING upd s ON t.c_custkey = ' || c || ' WHEN MATCHED THEN UPDATE SET c_mktsegment = ''X'''
       WHEN prio = '2-HIGH' THEN 'UPDATE main.sales.customer SET c_mktsegment = ''X'' WHERE c_custkey = ' || c
       WHEN prio = '3-MEDIUM' AND st <> 'p' THEN 'DELETE FROM main.sales.orders_f WHERE o_orderkey = ' || k
       WHEN prio = '5-LOW' AND st = 'o' THEN 'SELECT count(*) FROM main.stage.orders_' || st || ' o'
       WHEN prio = '5-LOW' THEN 'SELECT count(*) FROM main.stage.orders_' || st || ' o JOIN main.ref.calendar c ON o.o_orderdate = c.d' END AS out_sql,
  CASE WHEN prio = '4-NOT SPECIFIED' AND st = 'o' THEN 'kinit -kt svc.keytab svc'
       WHEN prio = '4-NOT SPECIFIED' AND st = 'f' THEN '# kinit -kt svc.keytab svc'
       WHEN prio = '4-NOT SPECIFIED' AND st = 'p' THEN chr(9) || '// hdfs dfs -ls /landing'
       WHEN prio = '5-LOW' AND st = 'p' THEN 'beeline -u jdbc:hive2://h -e ''select 1''' END AS extra_line
FROM o
"""


def _class_sql(col: str) -> str:
    # Written out on its own, not built from the operator's constants.
    return rf"""
CASE WHEN regexp_matches({col}, '(?i)\bINVALIDATE\s+METADATA\b') OR regexp_matches({col}, '(?i)\bREFRESH\s+\w+')
       OR regexp_matches({col}, '(?i)\bCOMPUTE\s+(INCREMENTAL\s+)?STATS\b')
       OR regexp_matches({col}, '(?i)\bSET\s+SYNC_DDL\b') THEN NULL
     WHEN regexp_matches({col}, '(?i)\bINSERT\s+(INTO|OVERWRITE)\b') THEN 'INSERT'
     WHEN regexp_matches({col}, '(?i)\bDELETE\s+FROM\b') THEN 'DELETE'
     WHEN regexp_matches({col}, '(?i)\bUPDATE\s+\w+') THEN 'UPDATE'
     WHEN regexp_matches({col}, '(?i)\bSELECT\b') THEN 'SELECT'
     WHEN regexp_matches({col}, '(?i)\bMERGE\s+INTO\b') THEN 'MERGE'
     WHEN regexp_matches({col}, '(?i)\bCREATE\s+') THEN 'CREATE' ELSE 'OTHER' END"""


@recipe("corpus_statement_class", f"""
SELECT script_id, stmt_no, sql, stmt_class FROM (
  SELECT script_id, stmt_no, sql, {_class_sql('sql')} AS stmt_class FROM ({STMT_SQL}) s) x
WHERE stmt_class IS NOT NULL
""")
def q_corpus_statement_class(spark, sf):
    s = _statements(spark, sf).select("script_id", "stmt_no", "sql")
    return CO.classify_statements(s)


@recipe("corpus_statement_coverage", f"""
WITH s AS (SELECT script_id, {_class_sql('sql')} AS sc, {_class_sql('out_sql')} AS oc
           FROM ({STMT_SQL}) x),
a AS (SELECT script_id, count(*) FILTER (WHERE sc IN ('INSERT', 'DELETE', 'UPDATE')) AS src_dml
      FROM s WHERE sc IS NOT NULL GROUP BY script_id),
b AS (SELECT script_id, count(*) FILTER (WHERE oc IN ('INSERT', 'DELETE', 'UPDATE', 'MERGE')) AS out_dml
      FROM s WHERE oc IS NOT NULL GROUP BY script_id)
SELECT coalesce(a.script_id, b.script_id) AS script_id, coalesce(src_dml, 0) AS src_dml,
       coalesce(out_dml, 0) AS out_dml,
       CASE WHEN coalesce(out_dml, 0) < coalesce(src_dml, 0) THEN 'error' ELSE 'ok' END AS status
FROM a FULL JOIN b ON a.script_id = b.script_id
""")
def q_corpus_statement_coverage(spark, sf):
    st = _statements(spark, sf)
    src = CO.classify_statements(st.select("script_id", "stmt_no", "sql"))
    out = CO.classify_statements(st.select("script_id", "stmt_no", F.col("out_sql").alias("sql"))
                                 .filter(F.col("sql").isNotNull()))
    return CO.compare_statement_counts(src, out)


def _refs_sql(col: str, cls_filter: bool = True) -> str:
    return f"""
SELECT DISTINCT script_id, parts[len(parts)] AS table_name FROM (
  SELECT script_id, string_split(lower(r), '.') AS parts FROM (
    SELECT script_id, unnest(regexp_extract_all({col}, '\\b\\w+(?:\\.\\w+)+\\b')) AS r
    FROM ({STMT_SQL}) x WHERE {col} IS NOT NULL AND {_class_sql(col)} IS NOT NULL) y) z
WHERE NOT list_has_any(parts, ['row_number', 'date_trunc', 'current_timestamp', 'current_date'])
"""


@recipe("corpus_missing_refs", f"""
{_refs_sql('sql')}
EXCEPT
{_refs_sql('out_sql')}
""")
def q_corpus_missing_refs(spark, sf):
    st = _statements(spark, sf)
    src = CO.classify_statements(st.select("script_id", "stmt_no", "sql"))
    out = CO.classify_statements(st.select("script_id", "stmt_no", F.col("out_sql").alias("sql"))
                                 .filter(F.col("sql").isNotNull()))
    return CO.missing(CO.table_refs(src, ["script_id"]), CO.table_refs(out, ["script_id"]),
                      ["script_id", "table_name"])


@recipe("corpus_leftovers", f"""
WITH l AS (SELECT script_id, out_sql AS line FROM ({STMT_SQL}) x WHERE out_sql IS NOT NULL
           UNION ALL
           SELECT script_id, extra_line FROM ({STMT_SQL}) x WHERE extra_line IS NOT NULL),
c AS (SELECT * FROM l WHERE NOT regexp_matches(line, '^[ \\t]*(#|//)'))
SELECT DISTINCT script_id, w AS word, 'error' AS severity FROM (
  SELECT script_id, 'impala-shell' AS w FROM c WHERE regexp_matches(line, '(?i)\\bimpala-shell\\b')
  UNION ALL SELECT script_id, 'kinit' FROM c WHERE regexp_matches(line, '(?i)\\bkinit\\b')
  UNION ALL SELECT script_id, 'beeline' FROM c WHERE regexp_matches(line, '(?i)\\bbeeline\\b')
  UNION ALL SELECT script_id, 'hdfs dfs' FROM c WHERE regexp_matches(line, '(?i)\\bhdfs\\s+dfs\\b')
  UNION ALL SELECT script_id, 'ssh' FROM c WHERE regexp_matches(line, '(?i)\\bssh\\s+')) h
""")
def q_corpus_leftovers(spark, sf):
    st = _statements(spark, sf)
    lines = st.select("script_id", F.col("out_sql").alias("line")).filter(F.col("line").isNotNull()) \
        .unionByName(st.select("script_id", F.col("extra_line").alias("line"))
                     .filter(F.col("line").isNotNull()))
    return CO.scan_leftovers(lines, ["script_id"])


# ------------------------------------------------------------ whole scripts

SCRIPT_ROWS = 100_000  # orders that a task of the join of whole scripts gets, about


def _scripts(spark, sf):
    """A whole script per order: a shell source, and a notebook cell of its conversion.

    The quoting of the statement follows the order's priority; statements that a
    conversion removes stay in some outputs, and some use positional parameters.
    The texts are written behind the join, and the number of its tasks follows the
    number of orders: by compressed bytes, which repeated texts and
    ascending keys make few, a task would get millions of them.
    """
    prio = F.col("prio")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // SCRIPT_ROWS))
    own = orders.select(F.col("o_orderkey").alias("__key"), F.col("o_orderpriority").alias("prio"))
    o = _written(orders.repartition(tasks, "o_orderkey").join(
        own.repartition(tasks, "__key"), F.col("o_orderkey") == F.col("__key")), "prio")
    shell = F.concat(F.lit('#!/bin/bash\nkinit -kt svc\nimpala-shell -i $1 -q "'), F.col("sql"),
                     F.lit("\" -o log\nimpala-shell -q 'REFRESH sales.orders'\n"))

    def call(quote: str, sql, prefix: str = ""):
        return F.concat(F.lit(f"spark.sql({prefix}{quote}"), sql, F.lit(f"{quote})"))

    sql = F.col("out_sql")
    quoted = F.when(prio == "1-URGENT", call('"' * 3, F.concat(F.lit("\n"), sql, F.lit("\n")), "f")) \
        .when(prio == "2-HIGH", call("'" * 3, F.concat(sql, F.lit("\n")))) \
        .when(sql.isNull(), call('"', F.lit("INVALIDATE METADATA sales.orders"))) \
        .otherwise(call('"', sql))
    head = F.when(prio == "5-LOW", F.lit('d = dbutils.widgets.get("d")\nrun("$1")\n')) \
        .when(prio == "3-MEDIUM", F.lit("run(${2}, $1)\n")).otherwise(F.lit(""))
    return o.select(F.col("stmt_no").alias("script_id"), shell.alias("source"),
                    F.concat(head, quoted, F.lit("\n")).alias("output"))


SCRIPT_SQL = f"""
SELECT s.*, o.o_orderpriority AS prio FROM ({STMT_SQL}) s JOIN orders o ON s.stmt_no = o.o_orderkey
"""


@recipe("corpus_extract_statements", f"""
WITH s AS ({SCRIPT_SQL})
SELECT 'source' AS side, stmt_no AS script_id, 1 AS stmt_no, sql FROM s
UNION ALL SELECT 'source', stmt_no, 2, 'REFRESH sales.orders' FROM s
UNION ALL SELECT 'output', stmt_no, 1, coalesce(out_sql, 'INVALIDATE METADATA sales.orders') FROM s
""")
def q_corpus_extract_statements(spark, sf):
    both = _scripts(spark, sf).select("script_id", F.explode(F.create_map(
        F.lit("source"), F.col("source"), F.lit("output"), F.col("output"))).alias("side", "content"))
    return CO.extract_statements(both, ["side", "script_id"])


@recipe("corpus_converted_scripts", f"""
WITH s AS ({SCRIPT_SQL})
SELECT stmt_no AS script_id, 'removable' AS finding, 'INVALIDATE METADATA' AS detail FROM s WHERE out_sql IS NULL
UNION ALL SELECT stmt_no, 'parameters', '1,2' FROM s WHERE prio = '3-MEDIUM'
""")
def q_corpus_converted_scripts(spark, sf):
    """Findings in converted scripts: statements that had to go, parameters without widgets."""
    out = _scripts(spark, sf).select("script_id", F.col("output").alias("content"))
    kinds = CO.removable_left(CO.extract_statements(out, ["script_id"]), ["script_id"])
    params = CO.positional_parameters(out, ["script_id"])
    return kinds.select("script_id", F.lit("removable").alias("finding"), F.col("kind").alias("detail")) \
        .unionByName(params.select("script_id", F.lit("parameters").alias("finding"),
                                   F.col("parameters").alias("detail")))
