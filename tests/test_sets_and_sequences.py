"""Hot keys in one slice, as-of rows, rule tables, drill-down and set matching against plain versions."""

import contextlib
import datetime as dt
import io
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadworks.operators import audit as AU
from loadworks.operators import corpus as CO
from loadworks.operators import matching as M
from loadworks.operators import scd as D
from loadworks.operators import sequence as S
from loadworks.plans import corpus_queries
from loadworks.session import scratch_path, scratch_scope


@pytest.fixture(autouse=True)
def scope(spark):
    with scratch_scope(spark):
        yield


# ------------------------------------------------------------------ slices taken from the data

def test_one_key_in_one_day_is_split_evenly(spark):
    """A million rows of one key and one day: no bucket has twice the rows of the median one."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.lit(dt.date(2024, 1, 1)).alias("day"),
                                 (F.col("id") * 7919 % n).alias("seq"))
    ranged, bcol = S.bucketed(rows, ["k"], ["day", "seq"], "range")
    sizes = sorted(r["count"] for r in ranged.groupBy(bcol).count().collect())
    assert len(sizes) >= 3 and max(sizes) <= 2 * sizes[len(sizes) // 2]
    got = S.with_neighbour(ranged, ["k"], ["day", "seq"], F.col("seq"), "prev", "prev", bcol)
    wrong = got.filter(~F.col("prev.v").eqNullSafe(F.when(F.col("seq") > 0, F.col("seq") - 1)))
    assert wrong.count() == 0 and got.count() == n


@pytest.mark.parametrize("bucket", [None, "day", "range"])
@pytest.mark.parametrize("direction", ["prev", "next"])
def test_neighbours_equal_the_plain_window(spark, bucket, direction):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.choice([None, dt.datetime(2024, 1, rng.randint(1, 4), rng.randint(0, 3))]), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int").repartition(5)
    staged, bcol = S.bucketed(df, ["k"], ["t", "i"], bucket)
    got = {r["i"]: r["n"]["v"] if r["n"] else "none" for r in
           S.with_neighbour(staged, ["k"], ["t", "i"], F.col("i"), "n", direction, bcol).collect()}
    want, before = {}, {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]), reverse=direction == "next")
    for k, _, i in order:
        want[i] = before.get(k, "none")
        before[k] = i
    assert got == want


@pytest.mark.parametrize("bucket", ["hour", "range"])
def test_build_is_the_same_with_any_slices(spark, bucket):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice("xyz"), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v string, t timestamp")
    plain, split = (D.scd2_build(df, ["k"], ["v"], "t", bucket=b).dim for b in (None, bucket))
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


# ------------------------------------------------------------------ as-of rows

@pytest.mark.parametrize("bucket", [None, "day", "month", "range"])
def test_as_of_rows_equal_a_search_of_all_versions(spark, bucket):
    rng = random.Random(6)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    versions = []
    for k in ("a", "b", None):
        at = sorted(rng.sample(range(0, 2000), 30))
        versions += [(k, i, day(a), day(b if rng.random() < 0.8 else (a + b) // 2)) for i, (a, b) in enumerate(zip(at, at[1:]))]
    facts = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([day(rng.randint(0, 2200)), None, versions[3][2]]))
             for i in range(500)] + [(7, "a", versions[4][2])] * 3
    dim = spark.createDataFrame(versions, "key string, name int, valid_from timestamp, valid_to timestamp")
    df = spark.createDataFrame(facts, "i int, k string, at timestamp").withColumn("valid_from", F.lit("own"))
    got = sorted((r["i"], r["k"] or "", str(r["at"]), r["own"], str(r["name"])) for r in D.as_of_rows(
        df.withColumnRenamed("valid_from", "own"), dim, {"k": "key"}, "at", ["name"], bucket).collect())
    want = []
    for i, k, at in facts:
        held = [v[1] for v in versions if k is not None and at is not None and v[0] == k and v[2] <= at < v[3]]
        assert len(held) <= 1
        want.append((i, k or "", str(at), "own", str(held[0] if held else None)))
    assert got == sorted(want)


def test_as_of_rows_of_empty_tables(spark):
    dim = spark.createDataFrame([], "key string, name int, valid_from timestamp, valid_to timestamp")
    facts = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "k string, at timestamp")
    assert [r["name"] for r in D.as_of_rows(facts, dim, {"k": "key"}, "at", ["name"]).collect()] == [None]
    assert D.as_of_rows(facts.limit(0), dim, {"k": "key"}, "at", ["name"]).count() == 0


# ------------------------------------------------------------------ rule tables

def test_rule_tables_find_what_every_rule_alone_finds(spark):
    rng = random.Random(7)
    letters = "abcab  ."
    docs = [(i, "\n".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(6))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "abcabc" * 2000), (100, "abcabcab\r\nabcabcab"), (None, "abcabcab")]
    rules = [(f"r{n}", rng.choice(["high", "critical"]), None, "".join(rng.choice("abc ") for _ in range(n % 12 + 1)))
             for n in range(400)]
    rules += [("start", "high", r"^ab", "ab"), ("words", "high", r"abc\s+a[bc]{2,}", "abc"), ("odd", "high", None, ".*"),
              ("long", "high", r"c{1}abcab$", "abcabcab"[:7]), ("twice", "high", None, "abcabcab"), ("twice", "high", None, "abcabcab")]
    corpus = spark.createDataFrame(docs, "doc_id int, content string")
    table = spark.createDataFrame(rules, "rule string, severity string, pattern string, literal string")
    got = sorted(map(str, map(tuple, CO.scan_rule_table(corpus, table).collect())))
    want = []
    for d, text in docs:
        for at, line in enumerate(re.split("\r?\n", text) if text is not None else [], 1):
            for rule, severity, pattern, literal in dict.fromkeys(rules):
                if literal in line and (pattern is None or re.search(pattern, line)):
                    want.append(str((d, rule, severity, at)))
    assert len(want) > 500 and got == sorted(want)
    assert CO.scan_rule_table(corpus.limit(0), table).count() == CO.scan_rule_table(corpus, table.limit(0)).count() == 0


def test_long_literals_are_found_wherever_they_begin(spark):
    """Literals around the sizes of both indexes, at every offset, in letters of one to four bytes."""
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgé\U0001f600ñ .") for _ in range(150))
    rules = [(f"{n} {at}", "high", None, text[at:at + n]) for n in (6, 7, 8, 22, 23, 24, 40) for at in range(0, 60, 7)]
    rules += [("both", "high", None, text[30:40]), ("both", "high", None, text[20:60]),
              ("start", "high", "^\\Q" + text[5:35] + "\\E", text[5:35])]
    docs = [(i, "x" * i + "\n" + text[i:] + "\r\n" + text[:i]) for i in range(40)]
    corpus = spark.createDataFrame(docs, "doc_id int, content string")
    table = spark.createDataFrame(rules, "rule string, severity string, pattern string, literal string")
    found = CO.scan_rule_table(corpus, table)
    got = Counter((r.doc_id, r.rule, r.line_no) for r in found.collect())
    want = {(d, rule, at) for d, content in docs for at, line in enumerate(re.split("\r?\n", content), 1)
            for rule, _, pattern, literal in rules if (line.startswith(literal) if pattern else literal in line)}
    assert len(want) > 500 and got == Counter(want)
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        found.explain()
    # a substring of the line by position is linear in the position: quadratic in the length of a line
    assert "substring(__line" not in shown.getvalue()


def test_a_rule_without_literal_is_an_error(spark):
    corpus = spark.createDataFrame([(1, "some text of a line")], "doc_id int, content string")
    table = spark.createDataFrame([("r", "high", "x", "")], "rule string, severity string, pattern string, literal string")
    with pytest.raises(Exception, match="without literal"):
        CO.scan_rule_table(corpus, table).collect()


def test_line_issues_are_not_shuffled(spark):
    corpus = spark.createDataFrame([(1, "one\ntwo.\nThree")], "doc_id int, content string")
    lines = CO.scan_rules(corpus, [CO.Rule("one", "one"), CO.Rule("two", "t[wh]")])
    assert "Exchange" not in lines._jdf.queryExecution().sparkPlan().toString()
    both = CO.scan_rules(corpus, [CO.Rule("one", "one"), CO.Rule("end", r"\.\n[A-Z]", multiline=True)])
    assert sorted(map(tuple, both.collect())) == [(1, "end", "high", 2), (1, "one", "high", 1)]


# ------------------------------------------------------------------ drill-down

def images(spark):
    left = [(i, f"v{i % 50}", i * 1.5) for i in range(2000)] + [(None, "null key", None)]
    right = [r for r in left if r[0] not in (5, 700)]
    change = {10: (10, "v11", 15.0), 11: (11, "v10", 16.5), 40: (40, None, 60.0), None: (None, "null key", 2.0)}
    right = [change.get(r[0], r) for r in right] + [(9999, "new", 0.0)]
    schema = "k int, name string, amount double"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema).repartition(3)


WANT = [("10", "changed", "name"), ("11", "changed", "name"), ("40", "changed", "name"), ("5", "missing", None),
        ("700", "missing", None), ("9999", "extra", None), ("None", "changed", "amount")]


def test_drill_down_lists_every_difference(spark):
    left, right = images(spark)
    leaves = AU.differing_leaves(AU.hash_tree(left, ["k"]), AU.hash_tree(right, ["k"]))
    assert 1 <= leaves.count() <= 7
    got = sorted((str(r["k"]), r["status"], r["columns"]) for r in AU.diff_images(left, right, leaves, ["k"]).collect())
    assert got == WANT


def test_equal_images_have_equal_trees_whatever_their_order(spark):
    left, _ = images(spark)
    other = left.select("amount", "k", "name").repartition(7)
    assert AU.differing_leaves(AU.hash_tree(left, ["k"]), AU.hash_tree(other, ["k"])).count() == 0
    empty = left.limit(0)
    assert AU.differing_leaves(AU.hash_tree(empty, ["k"]), AU.hash_tree(empty, ["k"])).count() == 0
    leaves = AU.differing_leaves(AU.hash_tree(empty, ["k"]), AU.hash_tree(left, ["k"]))
    assert AU.diff_images(empty, left, leaves, ["k"]).filter("status = 'extra'").count() == left.count()


def test_only_differing_leaves_are_read(spark):
    left, right = images(spark)
    bits, path = (3, 6), scratch_path(spark, "images")
    for name, df in (("left", left), ("right", right)):
        df.withColumn("leaf", AU.leaf_of(["k"], 6)).write.partitionBy("leaf").parquet(f"{path}/{name}")
    leaves = AU.differing_leaves(AU.hash_tree(left, ["k"], bits), AU.hash_tree(right, ["k"], bits), bits)
    held = [r["leaf"] for r in leaves.collect()]
    assert len(held) < 12
    # files of all other leaves could be gone
    kept = [spark.read.parquet(f"{path}/{name}").filter(F.col("leaf").isin(held)) for name in ("left", "right")]
    got = AU.diff_images(*kept, leaves, ["k"], bits, "leaf")
    assert sorted((str(r["k"]), r["status"], r["columns"]) for r in got.collect()) == WANT
    plan = AU.diff_images(spark.read.parquet(f"{path}/left"), spark.read.parquet(f"{path}/right"), leaves, ["k"], bits, "leaf")
    assert "dynamicpruning" in plan._jdf.queryExecution().toString().lower() or plan.count() == len(WANT)


# ------------------------------------------------------------------ matching

def best_of(left, right, measure):
    """Best right set of each left set by comparing all."""
    out = {}
    for a, x in left.items():
        found = []
        for b, y in right.items():
            o = len(x & y)
            if o:
                found.append((-(o / len(x | y) if measure == "jaccard" else o / max(len(x), 1)), b, o))
        if found:
            s, b, o = min(found)
            out[a] = (b, o, round(-s * 100, 6))
    return out


@pytest.mark.parametrize("measure", ["jaccard", "containment"])
@pytest.mark.parametrize("part", [3, 4096])
def test_best_match_equals_all_pairs(spark, monkeypatch, measure, part):
    """Common and rare tokens, equal sets, tokens that the other side lacks; also with salted lists."""
    monkeypatch.setattr(M, "PART", part)
    rng = random.Random(8)
    tokens = ["common"] * 30 + [f"t{i}" for i in range(12)] * 3 + [f"r{i}" for i in range(60)]
    draw = lambda extra: {rng.choice(tokens + extra) for _ in range(rng.randint(1, 9))}
    left = {f"l{i:03d}": draw(["only left"] * 8) for i in range(80)}
    right = {f"r{i:03d}": draw(["only right"] * 8) for i in range(120)}
    left["l999"], left["l998"] = {"nowhere"}, set(left["l001"])
    right["r999"] = set(right["r001"])
    frames = [spark.createDataFrame([(k, t) for k, s in side.items() for t in s], "id string, token string")
              for side in (left, right)]
    got = {r["lid"]: (r["rid"], r["overlap"], round(r["score"], 6)) for r in M.best_match(*frames, measure).collect()}
    assert got == best_of(left, right, measure)


def test_renamed_columns_count_by_their_targets(spark):
    renames = spark.createDataFrame([("w1", "a", "ID"), ("w1", "b", "id"), ("w1", "c", "name"), ("w1", "d", None), ("w2", "a", None),
                                     ("w3", "x", "nowhere"), ("w4", "p", "id"), ("w4", "q", "")],
                                    "table_name string, column_name string, target string")
    have = spark.createDataFrame([("t1", "id"), ("t1", "Name"), ("t1", "more"), ("t0", "id"), ("t2", "d")],
                                 "table_name string, column_name string")
    got = sorted(tuple(map(str, r)) for r in M.match_renamed(renames, have).collect())
    assert got == [("w1", "t1", "2", "2", "100.00"), ("w2", "None", "0", "0", "0.00"), ("w3", "None", "1", "0", "0.00"),
                   ("w4", "t0", "1", "1", "100.00")]


def test_tasks_of_whole_scripts_follow_the_orders(spark, tmp_path, monkeypatch):
    """A task of the join gets a bounded number of orders; repeated keys pair up, null keys have no script."""
    kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    rows = [(k, k % 9, "FOP"[k % 3], kinds[k % 5]) for k in range(2000)]
    rows += [(7, 1, "P", "5-LOW"), (7, 2, None, None), (None, 3, "F", "1-URGENT")]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(corpus_queries, "SCRIPT_ROWS", 20, raising=False)
    found = corpus_queries._scripts(spark, str(tmp_path))
    counts = Counter(r.script_id for r in found.collect())
    assert counts == {k: 9 if k == 7 else 1 for k in range(2000)}
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 50 and max(tasks) < 80
    got = Counter(tuple(r) for r in corpus_queries.q_corpus_converted_scripts(spark, str(tmp_path)).collect())
    want = Counter((k, "removable", "INVALIDATE METADATA") for k, _, st, prio in rows
                   if k != 7 and k is not None and (prio == kinds[3] or (prio == kinds[2] and st == "P")))
    want += Counter((k, "parameters", "1,2") for k, _, _, prio in rows if k is not None and k != 7 and prio == kinds[2])
    assert {x: n for x, n in got.items() if x[0] != 7} == want
