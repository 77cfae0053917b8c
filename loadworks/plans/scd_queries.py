"""Queries for the type-2 dimension operators (key user_id, effective ts,
attribute event_type, tie-break event_id; from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadworks.operators import checks as C
from loadworks.operators import scd as D
from loadworks.plans.registry import recipe, table
from loadworks.session import scratch_database
from loadworks.sources.sinks import publish

KEYS, ATTRS, EFF, TIE = ["user_id"], ["event_type"], "ts", ["event_id"]
SPLIT_AT = "2024-01-16 00:00:00"
LATE_DAY = ("2024-01-10 00:00:00", "2024-01-11 00:00:00")
AS_OF = "2024-01-20 00:00:00"


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def build_events(events):
    return D.scd2_build(events, KEYS, ATTRS, EFF, TIE).dim


def stored_dimension(spark, events, name="events_dim"):
    """Build the dimension and store it, as a load would before applying batches; the
    written table also cuts the lineage of later steps.  (``scd2_load`` stores it
    partitioned by ``is_current``.)"""
    db = scratch_database(spark)
    return publish(build_events(events), f"{db}.{name}")


BUILD_SQL = """
WITH s AS (SELECT user_id, event_type, ts, event_id,
                  lag(event_type) OVER w AS prev, row_number() OVER w AS rn
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
c AS (SELECT user_id, event_type, ts, event_id FROM s
      WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS valid_from,
       coalesce(lead(ts) OVER w2, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
       lead(ts) OVER w2 IS NULL AS is_current, event_id
FROM c WINDOW w2 AS (PARTITION BY user_id ORDER BY ts, event_id)
"""


@recipe("scd2_build", BUILD_SQL)
def q_scd2_build(spark, sf):
    return build_events(table(spark, sf, "events"))


@recipe("scd2_apply", BUILD_SQL)
def q_scd2_apply(spark, sf):
    ev = table(spark, sf, "events")
    dim = stored_dimension(spark, ev.filter(F.col(EFF) < _ts(SPLIT_AT)))
    return D.scd2_apply(dim, ev.filter(F.col(EFF) >= _ts(SPLIT_AT)), KEYS, ATTRS, EFF, TIE).image


@recipe("scd2_load", BUILD_SQL)
def q_scd2_load(spark, sf):
    """The stored dimension after a batch: closed files stay, the current partition is replaced."""
    ev = table(spark, sf, "events")
    name = f"{scratch_database(spark)}.events_dim"
    dim = build_events(ev.filter(F.col(EFF) < _ts(SPLIT_AT)))
    publish(dim, name, ["is_current"])
    D.load_batch(name, ev.filter(F.col(EFF) >= _ts(SPLIT_AT)), KEYS, ATTRS, EFF, TIE)
    return spark.table(name).select(*dim.columns)


def stops_at(name):
    """A step hook that ends a load there, as a death of the driver would."""
    def step(reached):
        if reached == name:
            raise InterruptedError(f"stopped after: {name}")
    return step


@recipe("scd2_load_recovered", BUILD_SQL)
def q_scd2_load_recovered(spark, sf):
    """Two batches; the load of each dies (before and after its record) and is run again."""
    ev = table(spark, sf, "events")
    name = f"{scratch_database(spark)}.events_dim"
    dim = build_events(ev.filter(F.col(EFF) < _ts(SPLIT_AT)))
    publish(dim, name, ["is_current"])
    batches = {"first": (F.col(EFF) >= _ts(SPLIT_AT)) & (F.col(EFF) < _ts(AS_OF)), "second": F.col(EFF) >= _ts(AS_OF)}
    for (load, rows), death in zip(batches.items(), ("staged", "moved")):
        try:
            D.load_batch(name, ev.filter(rows), KEYS, ATTRS, EFF, TIE, load_id=load, step=stops_at(death))
        except InterruptedError:
            D.load_batch(name, ev.filter(rows), KEYS, ATTRS, EFF, TIE, load_id=load)
        D.load_batch(name, ev.filter(rows), KEYS, ATTRS, EFF, TIE, load_id=load)  # changes nothing
    return spark.table(name).select(*dim.columns)


NULL_KEY_SQL = """
SELECT CASE WHEN u.c_custkey IS NULL THEN NULL ELSE e.user_id END AS user_id,
       e.event_type, e.ts, e.event_id
FROM events e LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') u
  ON e.user_id = u.c_custkey
"""


def events_with_null_keys(spark, sf):
    """Events whose user is not found among the customers of most segments get a NULL key."""
    ev = table(spark, sf, "events")
    users = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select("c_custkey")
    return ev.join(users, ev.user_id == users.c_custkey, "left").select(
        F.col("c_custkey").alias("user_id"), "event_type", "ts", "event_id")


@recipe("scd2_rejects", f"""
WITH e AS ({NULL_KEY_SQL})
SELECT 'build' AS load, event_id, event_type, ts FROM e WHERE user_id IS NULL
UNION ALL
SELECT 'apply', event_id, event_type, ts FROM e
WHERE user_id IS NULL AND ts >= TIMESTAMP '{SPLIT_AT}'
""")
def q_scd2_rejects(spark, sf):
    ev = events_with_null_keys(spark, sf)
    built = D.scd2_build(ev, KEYS, ATTRS, EFF, TIE)
    applied = D.scd2_apply(built.dim, ev.filter(F.col(EFF) >= _ts(SPLIT_AT)), KEYS, ATTRS, EFF, TIE)
    cols = ["event_id", "event_type", "ts"]
    return built.rejects.select(F.lit("build").alias("load"), *cols).unionByName(
        applied.rejects.select(F.lit("apply").alias("load"), *cols))


@recipe("scd2_late_rows", f"""
WITH d AS ({BUILD_SQL}),
cur AS (SELECT user_id, valid_from FROM d WHERE is_current)
SELECT e.* FROM events e JOIN cur ON e.user_id = cur.user_id
WHERE e.ts >= TIMESTAMP '{LATE_DAY[0]}' AND e.ts < TIMESTAMP '{LATE_DAY[1]}'
  AND e.ts <= cur.valid_from
""")
def q_scd2_late_rows(spark, sf):
    ev = table(spark, sf, "events")
    dim = stored_dimension(spark, ev)
    batch = ev.filter((F.col(EFF) >= _ts(LATE_DAY[0])) & (F.col(EFF) < _ts(LATE_DAY[1])))
    return D.scd2_apply(dim, batch, KEYS, ATTRS, EFF, TIE).late


@recipe("scd2_as_of", f"""
SELECT user_id, event_type, valid_from FROM ({BUILD_SQL}) d
WHERE valid_from <= TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' < valid_to
""")
def q_scd2_as_of(spark, sf):
    dim = build_events(table(spark, sf, "events"))
    return D.as_of(dim, AS_OF).select("user_id", "event_type", "valid_from")


@recipe("scd2_as_of_rows", f"""
WITH d AS ({BUILD_SQL}),
f AS (SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01' + INTERVAL (o_orderkey % 40) DAY AS at FROM orders)
SELECT f.*, d.event_type, d.valid_from FROM f LEFT JOIN d
  ON d.user_id = f.o_custkey AND d.valid_from <= f.at AND f.at < d.valid_to
""")
def q_scd2_as_of_rows(spark, sf):
    """Each order with its customer's version at the order's own instant (of a made-up month)."""
    day = (F.col("o_orderkey") % 40).cast("int")
    facts = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (
        _ts("2024-01-01 00:00:00") + F.make_dt_interval(day)).alias("at"))
    return D.as_of_rows(facts, build_events(table(spark, sf, "events")), {"o_custkey": "user_id"}, "at",
                        ["event_type", "valid_from"])


@recipe("scd2_hot_key", """
WITH s AS (SELECT 'all' AS shop, event_type, ts, event_id, lag(event_type) OVER w AS prev, row_number() OVER w AS rn
           FROM events WINDOW w AS (ORDER BY ts, event_id)),
c AS (SELECT * FROM s WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
SELECT shop, event_type, ts AS valid_from, coalesce(lead(ts) OVER w2, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
       lead(ts) OVER w2 IS NULL AS is_current, event_id
FROM c WINDOW w2 AS (ORDER BY ts, event_id)
""")
def q_scd2_hot_key(spark, sf):
    """All events are versions of one key; slices taken from the data split it."""
    ev = table(spark, sf, "events").withColumn("shop", F.lit("all"))
    return D.scd2_build(ev, ["shop"], ATTRS, EFF, TIE, bucket="range").dim


@recipe("scd2_current", f"""
SELECT user_id, event_type, valid_from FROM ({BUILD_SQL}) d WHERE is_current
""")
def q_scd2_current(spark, sf):
    dim = build_events(table(spark, sf, "events"))
    return D.current(dim, ["user_id", "event_type", "valid_from", "segment"])


@recipe("scd2_gaps", f"""
WITH d AS ({BUILD_SQL}),
r AS (SELECT * FROM d WHERE event_type <> 'click'),
g AS (SELECT user_id, valid_from, valid_to,
             lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS next_valid_from
      FROM r)
SELECT * FROM g
WHERE next_valid_from IS NOT NULL AND CAST(valid_to AS DATE) <> CAST(next_valid_from AS DATE)
""")
def q_scd2_gaps(spark, sf):
    dim = build_events(table(spark, sf, "events"))
    return D.version_gaps(dim.filter(F.col("event_type") != "click"), KEYS)


def corrupt(dim):
    """Break every invariant on purpose, driven by the data itself."""
    return dim.select(
        "user_id", "event_type", "valid_from",
        F.when((F.col("event_type") == "error") & ~F.col("is_current"),
               F.col("valid_to") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to"))
        .alias("valid_to"),
        F.when(F.col("event_type") == "view", F.lit(True))
        .when(F.col("event_type") == "signup", F.lit(False))
        .otherwise(F.col("is_current")).alias("is_current"))


CORRUPT_SQL = f"""
SELECT user_id, event_type, valid_from,
       CASE WHEN event_type = 'error' AND NOT is_current THEN valid_to + INTERVAL 1 DAY
            ELSE valid_to END AS valid_to,
       CASE WHEN event_type = 'view' THEN true WHEN event_type = 'signup' THEN false
            ELSE is_current END AS is_current
FROM ({BUILD_SQL}) b
"""


def _check_sql(variant: str, dim_sql: str, strict: bool) -> str:
    null_bad = " OR valid_to IS NULL" if strict else ""
    no_cur = " + count(*) FILTER (WHERE cur = 0)" if strict else ""
    return f"""
SELECT * FROM (
WITH d AS ({dim_sql}),
w AS (SELECT user_id, is_current, valid_to,
             lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS nxt FROM d),
k AS (SELECT user_id,
        count(*) FILTER (WHERE is_current) AS cur,
        count(*) FILTER (WHERE is_current AND (CAST(valid_to AS DATE) <> DATE '9999-12-31'{null_bad})) AS bad_cur,
        count(*) FILTER (WHERE NOT is_current AND CAST(valid_to AS DATE) = DATE '9999-12-31') AS open_old,
        count(*) FILTER (WHERE nxt IS NOT NULL AND (CAST(valid_to AS DATE) <> CAST(nxt AS DATE){null_bad})) AS gaps
      FROM w GROUP BY user_id),
a AS (SELECT count(*) FILTER (WHERE cur > 1){no_cur} AS dup, coalesce(sum(bad_cur), 0) AS bad_cur,
             coalesce(sum(open_old), 0) AS open_old, coalesce(sum(gaps), 0) AS gaps FROM k)
SELECT '{variant}' AS variant, 'Unique current record per BK' AS check_name,
       CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN dup > 0 THEN CAST(dup AS VARCHAR) || ' keys' END AS detail,
       CAST(dup AS DECIMAL(20,2)) AS measure FROM a
UNION ALL
SELECT '{variant}', 'Current valid_to = 9999-12-31', CASE WHEN bad_cur = 0 THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN bad_cur > 0 THEN CAST(bad_cur AS VARCHAR) || ' rows' END, CAST(bad_cur AS DECIMAL(20,2)) FROM a
UNION ALL
SELECT '{variant}', 'Superseded records closed', CASE WHEN open_old = 0 THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN open_old > 0 THEN CAST(open_old AS VARCHAR) || ' rows' END, CAST(open_old AS DECIMAL(20,2)) FROM a
UNION ALL
SELECT '{variant}', 'No date gaps', CASE WHEN gaps = 0 THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN gaps > 0 THEN CAST(gaps AS VARCHAR) || ' gaps' END, CAST(gaps AS DECIMAL(20,2)) FROM a)
"""


@recipe("check_scd2", _check_sql("clean", BUILD_SQL, True) + "\nUNION ALL\n"
        + _check_sql("corrupted", CORRUPT_SQL, False))
def q_check_scd2(spark, sf):
    dim = stored_dimension(spark, table(spark, sf, "events"))
    clean = C.check_scd2(dim, KEYS, strict=True).select(F.lit("clean").alias("variant"), "*")
    bad = C.check_scd2(corrupt(dim), KEYS, strict=False) \
        .select(F.lit("corrupted").alias("variant"), "*")
    return clean.unionByName(bad)
