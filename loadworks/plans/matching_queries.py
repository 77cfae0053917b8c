"""Queries for table and name matching (inventories derived from ``part``,
``supplier`` and ``nation``, so they grow with the data)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadworks.operators import matching as M
from loadworks.plans.audit_queries import part_inventories
from loadworks.plans.registry import recipe, table


def _have_wanted(spark, sf):
    src, out = part_inventories(spark, sf)
    have = src.select("table_name", "column_name")
    wanted = out.select(F.concat(F.lit("w_"), F.lower("table_name")).alias("table_name"),
                        "column_name")
    return have, wanted


_INV_SQL = """
p AS (SELECT *, 'brand_' || regexp_extract(p_brand, '([0-9]+)$', 1) || '_'
                || CAST(p_partkey // 1000 AS VARCHAR) AS t,
             'c' || CAST(p_partkey AS VARCHAR) AS c FROM part),
h AS (SELECT t, c FROM p),
w AS (SELECT 'w_' || t AS t, c FROM p WHERE p_brand <> 'Brand#1' AND NOT (p_size BETWEEN 2 AND 4)
      UNION ALL SELECT 'w_' || t, c || '_x' FROM p WHERE p_size = 50 AND p_brand <> 'Brand#1')"""

_BY_COLS_SQL = """
wn AS (SELECT t, count(*) AS n FROM w GROUP BY t),
ov AS (SELECT w.t AS wanted, h.t AS hname, count(*) AS o FROM w JOIN h ON w.c = h.c GROUP BY 1, 2),
sc AS (SELECT wanted, hname, o, CAST(round(o * 100.0 / greatest(wn.n, 1), 2) AS DECIMAL(7,2)) AS s,
              o * 1.0 / greatest(wn.n, 1) AS raw
       FROM ov JOIN wn ON ov.wanted = wn.t),
bc AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY raw DESC, hname) = 1)"""


@recipe("match_tables", f"""
WITH {_INV_SQL}, {_BY_COLS_SQL}
SELECT wn.t AS wanted, bc.hname AS best_match, coalesce(bc.o, 0) AS overlap,
       coalesce(bc.s, CAST(0 AS DECIMAL(7,2))) AS score
FROM wn LEFT JOIN bc ON wn.t = bc.wanted
""")
def q_match_tables(spark, sf):
    have, wanted = _have_wanted(spark, sf)
    return M.match_tables(wanted, have)


@recipe("match_renamed", f"""
WITH {_INV_SQL},
r AS (SELECT t, CASE WHEN c LIKE '%5' THEN NULL WHEN c LIKE '%7' THEN 'renamed_' || c ELSE upper(c) END AS target FROM w),
a AS (SELECT DISTINCT t, lower(target) AS c FROM r WHERE target IS NOT NULL),
an AS (SELECT t, count(*) AS n FROM a GROUP BY t),
ov AS (SELECT a.t AS wanted, h.t AS hname, count(*) AS o FROM a JOIN h ON a.c = h.c GROUP BY 1, 2),
b AS (SELECT * FROM ov QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY o DESC, hname) = 1)
SELECT wn.t AS wanted, b.hname AS best_match, coalesce(an.n, 0) AS targets, coalesce(b.o, 0) AS overlap,
       CAST(round(coalesce(b.o, 0) * 100.0 / greatest(coalesce(an.n, 0), 1), 2) AS DECIMAL(7,2)) AS score
FROM (SELECT DISTINCT t FROM w) wn LEFT JOIN an ON an.t = wn.t LEFT JOIN b ON b.wanted = wn.t
""")
def q_match_renamed(spark, sf):
    """Tables whose columns go by other names: some without one, some by one that nobody has."""
    have, wanted = _have_wanted(spark, sf)
    c = F.col("column_name")
    target = F.when(c.endswith("5"), F.lit(None)).when(c.endswith("7"), F.concat(F.lit("renamed_"), c)).otherwise(F.upper(c))
    return M.match_renamed(wanted.withColumn("target", target), have)


def _part_names(spark, sf):
    p = table(spark, sf, "part")
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("")))
    have = p.select(F.concat_ws(" ", "p_name", F.lower("p_type"), brand).alias("name")).distinct()
    wanted = p.select(F.concat_ws(" ", "p_name", brand).alias("name")).distinct()
    return have, wanted


def _tok_sql(rel: str) -> str:
    return (f"SELECT DISTINCT name, unnest(string_split(trim(regexp_replace(lower(name), "
            f"'[_\\s]+', ' ', 'g')), ' ')) AS token FROM {rel}")


@recipe("match_names", f"""
WITH h AS (SELECT DISTINCT p_name || ' ' || lower(p_type) || ' ' || lower(replace(p_brand, '#', '')) AS name FROM part),
w AS (SELECT DISTINCT p_name || ' ' || lower(replace(p_brand, '#', '')) AS name FROM part),
ht AS ({_tok_sql('h')}), wt AS ({_tok_sql('w')}),
hn AS (SELECT name, count(*) AS n FROM ht GROUP BY name),
wn AS (SELECT name, count(*) AS n FROM wt GROUP BY name),
ov AS (SELECT wt.name AS wname, ht.name AS hname, count(*) AS o FROM wt JOIN ht ON wt.token = ht.token
       GROUP BY 1, 2),
sc AS (SELECT wname, hname, o * 1.0 / (wn.n + hn.n - o) AS s FROM ov
       JOIN wn ON ov.wname = wn.name JOIN hn ON ov.hname = hn.name),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY wname ORDER BY s DESC, hname) = 1)
SELECT w.name AS wanted, b.hname AS best_match,
       CAST(round(coalesce(b.s, 0) * 100, 2) AS DECIMAL(7,2)) AS score
FROM w LEFT JOIN b ON w.name = b.wname
""")
def q_match_names(spark, sf):
    have, wanted = _part_names(spark, sf)
    return M.match_names(wanted, have)


def _resolve_inputs(spark, sf):
    have_cols, wanted = _have_wanted(spark, sf)
    s = table(spark, sf, "supplier")
    by_name = s.select(F.concat(F.lit("w_legacy_"), (F.col("s_nationkey") % 5).cast("string"), F.lit("_"),
                                F.floor(F.col("s_suppkey") / 100).cast("string")).alias("table_name"),
                       F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("column_name"))
    orphan = table(spark, sf, "region").select(
        F.concat(F.lit("orphan_"), F.lower("r_name")).alias("table_name"),
        F.lit("nothing").alias("column_name"))
    legacy = table(spark, sf, "nation").select(
        F.concat(F.lit("legacy_"), F.col("n_regionkey").cast("string")).alias("table_name")).distinct()
    have_tables = have_cols.select("table_name").distinct().unionByName(legacy)
    # brand 3 tables have aliases: to a legacy table that exists, and to one that does not
    alias = table(spark, sf, "part").filter(F.col("p_brand") == "Brand#3").select(
        F.concat(F.lit("w_brand_3_"), F.floor(F.col("p_partkey") / 1000).cast("string")).alias("table_name")) \
        .distinct().select("table_name", F.explode(F.array(F.lit("legacy_4"), F.lit("gone"))).alias("target"))
    return wanted.unionByName(by_name).unionByName(orphan), have_tables, have_cols, alias


@recipe("match_resolve", f"""
WITH {_INV_SQL},
ws AS (SELECT 'w_legacy_' || CAST(s_nationkey % 5 AS VARCHAR) || '_' || CAST(s_suppkey // 100 AS VARCHAR) AS t, 's' || CAST(s_suppkey AS VARCHAR) AS c
       FROM supplier
       UNION ALL SELECT 'orphan_' || lower(r_name), 'nothing' FROM region),
wall AS (SELECT * FROM w UNION ALL SELECT * FROM ws),
lg AS (SELECT DISTINCT 'legacy_' || CAST(n_regionkey AS VARCHAR) AS name FROM nation),
wn AS (SELECT t, count(*) AS n FROM wall GROUP BY t),
ov AS (SELECT wall.t AS wanted, h.t AS hname, count(*) AS o FROM wall JOIN h ON wall.c = h.c GROUP BY 1, 2),
sc AS (SELECT wanted, hname, CAST(round(o * 100.0 / greatest(wn.n, 1), 2) AS DECIMAL(7,2)) AS s,
              o * 1.0 / greatest(wn.n, 1) AS raw FROM ov JOIN wn ON ov.wanted = wn.t),
al AS (SELECT DISTINCT 'w_brand_3_' || CAST(p_partkey // 1000 AS VARCHAR) AS wanted, 'legacy_4' AS hname
       FROM part WHERE p_brand = 'Brand#3'),
bc AS (SELECT wanted, hname, raw, s, 'columns' AS how FROM sc
       QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY raw DESC, hname) = 1),
wtk AS ({_tok_sql('(SELECT DISTINCT t AS name FROM wall)')}),
ltk AS ({_tok_sql('lg')}),
wtn AS (SELECT name, count(*) AS n FROM wtk GROUP BY name),
ltn AS (SELECT name, count(*) AS n FROM ltk GROUP BY name),
nov AS (SELECT wtk.name AS wanted, ltk.name AS hname, count(*) AS o FROM wtk JOIN ltk ON wtk.token = ltk.token
        GROUP BY 1, 2),
nsc AS (SELECT wanted, hname, o * 1.0 / (wtn.n + ltn.n - o) AS raw FROM nov
        JOIN wtn ON nov.wanted = wtn.name JOIN ltn ON nov.hname = ltn.name),
bn AS (SELECT wanted, hname, raw, CAST(round(raw * 100, 2) AS DECIMAL(7,2)) AS s, 'name' AS how FROM nsc
       QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY raw DESC, hname) = 1),
pool AS (SELECT * FROM bc UNION ALL SELECT * FROM bn
         UNION ALL SELECT wanted, hname, 1.0, CAST(100 AS DECIMAL(7,2)), 'alias' FROM al),
best AS (SELECT * FROM pool
         QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY how <> 'alias', raw DESC, hname) = 1),
widest AS (SELECT t FROM (SELECT t, count(*) AS n FROM h GROUP BY t) x ORDER BY n DESC, t LIMIT 1)
SELECT wn.t AS wanted, coalesce(best.hname, (SELECT t FROM widest)) AS resolved,
       coalesce(best.s, CAST(0 AS DECIMAL(7,2))) AS score, coalesce(best.how, 'widest') AS how
FROM wn LEFT JOIN best ON wn.t = best.wanted
""")
def q_match_resolve(spark, sf):
    wanted, have_tables, have_cols, aliases = _resolve_inputs(spark, sf)
    return M.resolve_tables(wanted, have_tables, have_cols, aliases)
