"""Queries for the apply operators (upsert & co.) and the table sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, LongType, StringType, StructField, StructType,
                               TimestampType)

from loadworks.operators import apply as A
from loadworks.operators import touched as T
from loadworks.operators.shaping import with_partition_columns
from loadworks.plans.registry import recipe, table
from loadworks.session import scratch_database, scratch_path
from loadworks.sources import sinks as K
from loadworks.sources.journal import append_once

RELOAD_DAY = "1997-06-15"


@recipe("upsert", """
WITH t AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'),
b AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment, 1 AS seq
      FROM customer WHERE c_nationkey < 10
      UNION ALL
      SELECT c_custkey, c_name, c_nationkey, c_acctbal + 200, c_mktsegment, 2
      FROM customer WHERE c_nationkey = 0),
bl AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM b
       QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.c_custkey = t.c_custkey)
UNION ALL SELECT * FROM bl
""")
def q_upsert(spark, sf):
    c = table(spark, sf, "customer")
    target = c.filter(F.col("c_mktsegment") != "MACHINERY")
    first = c.filter(F.col("c_nationkey") < 10).select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 100).alias("c_acctbal"),
        "c_mktsegment", F.lit(1).alias("seq"))
    second = c.filter(F.col("c_nationkey") == 0).select(
        "c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 200).alias("c_acctbal"),
        "c_mktsegment", F.lit(2).alias("seq"))
    return A.upsert(target, first.unionByName(second), ["c_custkey"], order_by=["seq"]).image


@recipe("upsert_rejects", """
SELECT o.o_orderkey, o.o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)
""")
def q_upsert_rejects(spark, sf):
    """Orders as a batch for their customers; those without one in credit have a NULL key."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    known = c.filter(F.col("c_acctbal") > 0).select("c_custkey")
    batch = o.join(known, o.o_custkey == known.c_custkey, "left").select(
        "c_custkey", F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    target = c.select("c_custkey", "c_acctbal")
    return A.upsert(target, batch, ["c_custkey"], order_by=["o_orderkey"]).rejects.select(
        "o_orderkey", F.col("c_acctbal").alias("o_totalprice"))


@recipe("update_from_join", """
WITH s AS (SELECT o_custkey AS c_custkey,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio
           FROM orders WHERE o_orderpriority <> '5-LOW'
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.prio ELSE c.c_mktsegment END AS c_mktsegment
FROM customer c LEFT JOIN s ON c.c_custkey = s.c_custkey
""")
def q_update_from_join(spark, sf):
    # customers whose orders are all of low priority stay unmatched
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    newest = A.latest_per_key(
        o.select("o_custkey", "o_orderdate", "o_orderkey",
                 F.when(F.col("o_orderstatus") == "P", None)
                 .otherwise(F.col("o_orderpriority")).alias("prio")),
        ["o_custkey"], ["o_orderdate", "o_orderkey"])
    source = newest.select(F.col("o_custkey").alias("c_custkey"), "prio")
    return A.update_from(table(spark, sf, "customer"), source, ["c_custkey"],
                         {"c_mktsegment": "prio"})


@recipe("delete_matching", """
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
  GROUP BY o.o_custkey HAVING max(o.o_totalprice) > 490000)
""")
def q_delete_matching(spark, sf):
    o = table(spark, sf, "orders")
    gone = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("most")) \
        .filter(F.col("most") > 490000)
    return A.delete_matching(table(spark, sf, "customer"), gone, ["c_custkey"])


@recipe("latest_per_key", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def q_latest_per_key(spark, sf):
    return A.latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


@recipe("snk_replace_where", f"""
WITH ship AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS ship_date
              FROM lineitem GROUP BY l_orderkey),
e AS (SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, s.ship_date, 0 AS batch_id
      FROM orders o LEFT JOIN ship s ON o.o_orderkey = s.l_orderkey)
SELECT * FROM e WHERE NOT coalesce(ship_date = DATE '{RELOAD_DAY}', false)
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice + 1, ship_date, 1 FROM e
WHERE ship_date = DATE '{RELOAD_DAY}'
""")
def q_snk_replace_where(spark, sf):
    ship = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("date").alias("ship_date"))
    o = table(spark, sf, "orders")
    existing = o.join(ship, o.o_orderkey == ship.l_orderkey, "left").select(
        "o_orderkey", "o_custkey", "o_totalprice", "ship_date", F.lit(0).alias("batch_id"))
    pred = F.col("ship_date") == F.lit(RELOAD_DAY).cast("date")
    rebuilt = existing.filter(pred).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "ship_date", F.lit(1).alias("batch_id"))
    return A.replace_where(existing, rebuilt, pred)


def _monthly_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@recipe("snk_partition_overwrite", """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month
           FROM orders),
img AS (SELECT * FROM o WHERE month NOT IN ('1996-01', '1996-02')
        UNION ALL
        SELECT * FROM o WHERE month IN ('1996-01', '1996-02')
          AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT month, count(*) AS row_count, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
FROM img GROUP BY month
""")
def q_snk_partition_overwrite(spark, sf):
    o = _monthly_orders(spark, sf)
    db = scratch_database(spark)
    name = f"{db}.orders_by_month"
    o.write.format("parquet").partitionBy("month").saveAsTable(name)
    batch = o.filter(F.col("month").isin("1996-01", "1996-02")
                     & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    K.insert_partitions(batch, name)
    return spark.table(name).groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))


@recipe("snk_publish", """
SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM orders
""")
def q_snk_publish(spark, sf):
    db = scratch_database(spark)
    name = f"{db}.orders_pub"
    K.publish(table(spark, sf, "orders"), name)
    # The second image is computed from the table it replaces.
    current = spark.table(name)
    return K.publish(current.withColumn("o_orderstatus", F.lower("o_orderstatus")), name)


@recipe("snk_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def q_snk_append(spark, sf):
    db = scratch_database(spark)
    name = f"{db}.orders_app"
    o = table(spark, sf, "orders")
    K.append_with_retry(o, name)
    K.append_with_retry(o, name)
    return spark.table(name)


@recipe("snk_append_once", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def q_snk_append_once(spark, sf):
    """Two batches, each of them sent again as if its answer had been lost."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders-once")
    for load in ("monday", "monday", "tuesday", "monday", "tuesday"):
        append_once(o, path, load)
    return spark.read.parquet(path)


@recipe("snk_publish_version", """
SELECT 'second' AS version, o_orderkey, lower(o_orderstatus) AS o_orderstatus FROM orders
UNION ALL SELECT 'first', o_orderkey, o_orderstatus FROM orders
""")
def q_snk_publish_version(spark, sf):
    """The name shows the second image; a reader that had begun before still sees the first."""
    name = f"{scratch_database(spark)}.orders_shown"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    K.publish_version(o, name)
    begun = K.pinned(spark, name)
    now = K.publish_version(spark.table(name).withColumn("o_orderstatus", F.lower("o_orderstatus")), name)
    return now.select(F.lit("second").alias("version"), "*").unionByName(begun.select(F.lit("first").alias("version"), "*"))


def _stored_orders(spark, sf, *partition_by):
    """Orders in files that are sorted by key (and by month, if partitioned by it)."""
    path = scratch_path(spark, "orders-files")
    o = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.partitionBy(*partition_by).parquet(path)
    return path


RECENT_SQL = "o_orderkey * 5 > (SELECT max(o_orderkey) * 4 FROM orders)"
_ORDERS_SQL = "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders"


def _recent(orders):
    """The orders of the last fifth of the keys."""
    last = orders.agg(F.max("o_orderkey").alias("last"))
    return orders.join(F.broadcast(last), F.col("o_orderkey") * 5 > F.col("last") * 4).drop("last")


@recipe("upsert_files", f"""
WITH o AS ({_ORDERS_SQL}),
b AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority, month
      FROM o WHERE {RECENT_SQL} AND o_orderstatus = 'F'
      UNION ALL
      SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority, month
      FROM o WHERE {RECENT_SQL} AND o_orderpriority = '1-URGENT')
SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b
""")
def q_upsert_files(spark, sf):
    path = _stored_orders(spark, sf)
    recent = _recent(spark.read.parquet(path))
    changed = recent.filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X")) \
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = recent.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", -F.col("o_orderkey")) \
        .withColumn("o_orderstatus", F.lit("N"))
    T.upsert_files(spark, path, changed.unionByName(new), ["o_orderkey"])
    return spark.read.parquet(path)


@recipe("update_files", f"""
SELECT * EXCLUDE (c_mktsegment) REPLACE (
  CASE WHEN {RECENT_SQL} THEN CASE WHEN o_totalprice < 100000 THEN NULL ELSE c_mktsegment END
       ELSE o_orderpriority END AS o_orderpriority)
FROM (SELECT o.*, c_mktsegment FROM ({_ORDERS_SQL}) o LEFT JOIN customer ON c_custkey = o_custkey)
""")
def q_update_files(spark, sf):
    """Recent orders take the segment of their customer (NULL if they are small)."""
    path = _stored_orders(spark, sf)
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    source = _recent(spark.read.parquet(path)).join(c, "o_custkey", "left").select(
        "o_orderkey", F.when(F.col("o_totalprice") >= 100000, F.col("c_mktsegment")).alias("value"))
    T.update_files(spark, path, source, ["o_orderkey"], {"o_orderpriority": "value"})
    return spark.read.parquet(path)


@recipe("delete_files", f"SELECT * FROM ({_ORDERS_SQL}) o WHERE NOT ({RECENT_SQL} AND o_orderstatus = 'O')")
def q_delete_files(spark, sf):
    path = _stored_orders(spark, sf)
    gone = _recent(spark.read.parquet(path)).filter("o_orderstatus = 'O'")
    T.delete_files(spark, path, gone, ["o_orderkey"])
    return spark.read.parquet(path)


@recipe("replace_files", f"""
SELECT * FROM ({_ORDERS_SQL}) o WHERE month <> '1996-02'
UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM ({_ORDERS_SQL}) o
WHERE month = '1996-02' AND o_orderpriority <> '5-LOW'
""")
def q_replace_files(spark, sf):
    """A month is loaded again; the files of other months stay."""
    path = _stored_orders(spark, sf, "month")
    stored = spark.read.parquet(path)
    new = stored.filter("month = '1996-02' AND o_orderpriority <> '5-LOW'") \
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    T.replace_files(spark, path, new, F.col("month") == "1996-02", ["month"])
    return spark.read.parquet(path).select(*stored.columns)


_ORDER_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
               ("o_orderpriority", "string"), ("ptn_yyyy", "string"), ("ptn_mm", "string")]


@recipe("snk_clone_empty", "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS ordinal, '{n}' AS column_name, '{t}' AS data_type, "
    f"count({'*' if n.startswith('ptn') else n}) AS non_nulls FROM orders"
    for i, (n, t) in enumerate(_ORDER_COLS)))
def q_snk_clone_empty(spark, sf):
    db = scratch_database(spark)
    name = f"{db}.orders_clone"
    o = table(spark, sf, "orders")
    K.create_clone(o, name, {"ptn_yyyy": "string", "ptn_mm": "string"}, ["ptn_yyyy", "ptn_mm"])
    loaded = with_partition_columns(o, "o_orderdate")
    K.insert_partitions(loaded, name)
    return K.column_inventory(spark.table(name))


@recipe("snk_clone_first", "\nUNION ALL\n".join(
    f"SELECT '{want}' AS wanted, '{found}' AS cloned, count({column}) AS rows_in_clone FROM orders WHERE false"
    for want, found, column in (("in_orders", "in_orders", "o_orderkey"), ("in_parts", "parts", "o_orderkey"))))
def q_snk_clone_first(spark, sf):
    """Empty partition tables from the first source that can be read: the landed table, else the base table."""
    db = scratch_database(spark)
    table(spark, sf, "orders").write.format("parquet").saveAsTable(f"{db}.in_orders")
    table(spark, sf, "part").write.format("parquet").saveAsTable(f"{db}.parts")
    out = None
    for name in ("orders", "parts"):
        found = K.create_clone_of_first(spark, [f"{db}.in_{name}", f"{db}.{name}"], f"{db}.p_{name}",
                                        {"ptn_yyyy": "string"}, ["ptn_yyyy"])
        made = spark.table(f"{db}.p_{name}").agg(F.count(F.lit(1)).alias("rows_in_clone")).select(
            F.lit(f"in_{name}").alias("wanted"), F.lit(found.rpartition(".")[2]).alias("cloned"), "rows_in_clone")
        out = made if out is None else out.unionByName(made)
    return out


TXN_DAILY = StructType([
    StructField("txn_id", LongType()), StructField("account_id", LongType()),
    StructField("amount", DecimalType(18, 2)), StructField("txn_date", StringType()),
    StructField("load_ts", TimestampType()),
])
_TXN_COLS = [("txn_id", "bigint"), ("account_id", "bigint"), ("amount", "decimal(18,2)"),
             ("load_ts", "timestamp"), ("txn_date", "string")]


@recipe("snk_ensure_table", "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS ordinal, '{n}' AS column_name, '{t}' AS data_type, "
    f"count(*) AS non_nulls FROM orders" for i, (n, t) in enumerate(_TXN_COLS)))
def q_snk_ensure_table(spark, sf):
    db = scratch_database(spark)
    name = f"{db}.txn_daily"
    K.ensure_table(spark, name, TXN_DAILY, ["txn_date"], {"amount": "transaction amount"})
    K.ensure_table(spark, name, TXN_DAILY, ["txn_date"])  # second call is a no-op
    o = table(spark, sf, "orders")
    txns = o.select(F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("account_id"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                    F.date_format("o_orderdate", "yyyy-MM-01").alias("txn_date"),
                    F.col("o_orderdate").cast("timestamp").alias("load_ts"))
    K.insert_partitions(txns, name)
    return K.column_inventory(spark.table(name))


@recipe("snk_ensure_view", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def q_snk_ensure_view(spark, sf):
    db = scratch_database(spark)
    K.publish(table(spark, sf, "supplier"), f"{db}.supplier")
    return K.ensure_view(spark, f"{db}.v_supplier",
                         f"SELECT s_suppkey, s_name, s_acctbal FROM {db}.supplier WHERE s_acctbal > 0")
