"""Unit tests on hand-written rows: edges, negative controls, invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadworks.functions import scalar as S
from loadworks.operators import apply as A
from loadworks.operators import audit as AU
from loadworks.operators import checks as C
from loadworks.operators import control as CT
from loadworks.operators import corpus as CO
from loadworks.operators import matching as M
from loadworks.operators import scd as D
from loadworks.operators import shaping as P
from loadworks.operators.joins import Lookup, enrich


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ scalars

def test_translate_date_format():
    assert S.translate_date_format("YYYY-MM-DD %hh:%nn:%ss") == "yyyy-MM-dd HH:mm:ss"


def test_scalars_edges(spark):
    df = spark.createDataFrame([("2024-01-31", " a ", None), ("2024-13-01", "", "x"),
                                ("", None, "NULL")], "d string, s string, n string")
    out = df.select(S.date_text_to_timestamp("d").alias("ts"), S.null_to_empty("s").alias("e"),
                    S.null_if_text_null("n").alias("nn"),
                    S.date_offset_by_components(F.lit("2024-01-31"), 0, 1, 0).alias("feb"),
                    S.power(F.lit(2), 3).alias("p"), S.card_mask(F.lit("4000123412341234")).alias("m"))
    got = out.collect()
    assert got[0]["ts"] == dt.datetime(2024, 1, 31)
    assert got[1]["ts"] is None and got[2]["ts"] is None      # unparsable / blank -> NULL
    assert [r["e"] for r in got] == [" a ", "", ""]
    assert [r["nn"] for r in got] == [None, "x", None]
    assert got[0]["feb"] == dt.date(2024, 2, 29)              # month end clamps
    assert got[0]["p"] == 8.0                                  # not XOR
    assert got[0]["m"] == "400012******1234"


# ------------------------------------------------------------------ shaping

def test_rename_pad_project(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], ["aa.ip_id", "NAME", "extra"])
    renamed = P.rename_columns(df, {"IP_ID": "id", "name": "full_name"})
    assert renamed.columns == ["id", "full_name", "extra"]
    padded = P.pad_columns(renamed, ["id", "load_ts", "batch"])
    assert padded.columns == ["id", "full_name", "extra", "load_ts", "batch"]
    assert P.project_common(padded, ["BATCH", "Id", "zzz"]).columns == ["BATCH", "Id"]
    with pytest.raises(ValueError):
        P.project_to(df, ["missing"])
    assert dict(P.cast_all_string(df).dtypes) == {"aa.ip_id": "string", "NAME": "string",
                                                  "extra": "string"}


def test_enrich_no_fanout_and_null_lookup(spark):
    main = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, k int")
    lk = spark.createDataFrame([(10, "a"), (10, "a"), (20, "b")], "key int, v string")
    out = enrich(main, [Lookup(lk, {"k": "key"}, ["v"])])
    assert out.count() == 3
    assert rows(out, "id", "v") == [(1, "a"), (2, "b"), (3, None)]


# ------------------------------------------------------------------ apply

def test_upsert_latest_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1), (None, "n", 1)],
                              "k int, v string, seq int")
    img, rejects = A.upsert(t, b, ["k"], order_by=["seq"])
    assert rows(img) == [(1, "a"), (2, "y"), (3, "z")]
    # upsert twice = once
    again = A.upsert(img, b, ["k"], order_by=["seq"]).image
    assert rows(again) == rows(img)
    assert rows(rejects) == [(None, "n", 1)]


def test_upsert_duplicate_without_order_fails(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception):
        A.upsert(t, b, ["k"]).image.collect()


def test_update_from_matched_null_wins(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(1, None)], "k int, nv string")
    assert rows(A.update_from(t, s, ["k"], {"v": "nv"})) == [(1, None), (2, "b")]


def test_replace_where_keeps_null_predicate(spark):
    e = spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-01-02")], "k int, d string")
    n = spark.createDataFrame([(9, "2024-01-01")], "k int, d string")
    out = A.replace_where(e, n, F.col("d") == "2024-01-01")
    assert rows(out) == [(2, None), (3, "2024-01-02"), (9, "2024-01-01")]


def test_overwrite_partitions(spark):
    e = spark.createDataFrame([(1, "m1"), (2, "m2"), (3, "m2")], "k int, m string")
    n = spark.createDataFrame([(4, "m2")], "k int, m string")
    assert rows(A.overwrite_partitions(n, e, ["m"])) == [(1, "m1"), (4, "m2")]


# ------------------------------------------------------------------ SCD2

def _hist(spark):
    ts = lambda d, h=0: dt.datetime(2024, 1, d, h)
    return spark.createDataFrame([
        (1, "a", ts(1)), (1, "a", ts(2)), (1, "b", ts(3)), (1, None, ts(4)), (1, None, ts(5)),
        (2, "x", ts(1)), (2, "y", ts(1, 5)), (None, "q", ts(1)),
    ], "k int, attr string, eff timestamp_ntz")


def test_scd2_build_rules(spark):
    dim = D.scd2_build(_hist(spark), ["k"], ["attr"], "eff").dim
    got = rows(dim, "k", "attr", "valid_from", "is_current")
    want = [(1, "a", dt.datetime(2024, 1, 1), False), (1, "b", dt.datetime(2024, 1, 3), False),
            (1, None, dt.datetime(2024, 1, 4), True), (2, "x", dt.datetime(2024, 1, 1), False),
            (2, "y", dt.datetime(2024, 1, 1, 5), True)]
    assert got == sorted(want, key=repr)     # NULL key row left out, repeats collapsed
    checks = {r["check_name"]: r["status"] for r in
              C.check_scd2(dim, ["k"], strict=True).collect()}
    # 2024-01-01 05:00 starts y while x ends that day: same date, no gap
    assert set(checks.values()) == {"PASS"}


def test_scd2_apply_equals_full_build_and_is_idempotent(spark):
    h = _hist(spark).filter(F.col("k").isNotNull())
    full = D.scd2_build(h, ["k"], ["attr"], "eff").dim
    first = D.scd2_build(h.filter(F.col("eff") < dt.datetime(2024, 1, 3)), ["k"], ["attr"], "eff").dim
    rest = h.filter(F.col("eff") >= dt.datetime(2024, 1, 3))
    img, late, _ = D.scd2_apply(first, rest, ["k"], ["attr"], "eff")
    assert rows(img) == rows(full) and late.count() == 0
    # a load stores the image before the next batch; checkpoint() cuts the lineage
    img = img.checkpoint()
    img2, late2, _ = D.scd2_apply(img, rest, ["k"], ["attr"], "eff")
    assert rows(img2) == rows(img)          # same batch twice: nothing changes
    # rows at or before the current version's start come back as late rows
    assert late2.count() == 2


def test_scd2_check_negative_control(spark):
    dim = D.scd2_build(_hist(spark), ["k"], ["attr"], "eff").dim
    broken = dim.withColumn("is_current", F.lit(True))
    res = {r["check_name"]: r["status"] for r in C.check_scd2(broken, ["k"]).collect()}
    assert res["Unique current record per BK"] == "FAIL"
    assert res["Current valid_to = 9999-12-31"] == "FAIL"


def test_scd2_same_instant_without_tie_fails(spark):
    h = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (1, "b", dt.datetime(2024, 1, 1))],
                              "k int, attr string, eff timestamp_ntz")
    with pytest.raises(Exception):
        D.scd2_build(h, ["k"], ["attr"], "eff").dim.collect()


@pytest.mark.parametrize("order", [(0, 1, 2), (0, 2, 1), (2, 1, 0)])
def test_scd2_same_instant_fails_in_every_row_order(spark, order):
    data = [(1, "a", dt.datetime(2024, 1, 1)), (1, "a", dt.datetime(2024, 1, 2)), (1, "b", dt.datetime(2024, 1, 2))]
    h = spark.createDataFrame([data[i] for i in order], "k int, attr string, eff timestamp_ntz").coalesce(1)
    for bucket in ("day", None):
        with pytest.raises(Exception, match="share key and instant"):
            D.scd2_build(h, ["k"], ["attr"], "eff", bucket=bucket).dim.collect()


def test_scd2_apply_keeps_null_flags_and_returns_rejects(spark):
    ts = dt.datetime
    end = ts(9999, 12, 31)
    dim = spark.createDataFrame(
        [(1, "a", ts(2024, 1, 1), end, True), (2, "b", ts(2024, 1, 1), end, None),
         (None, "c", ts(2024, 1, 1), end, True), (3, "d", ts(2024, 1, 1), ts(2024, 1, 5), False)],
        "k int, attr string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    batch = spark.createDataFrame([(1, "x", ts(2024, 2, 1)), (None, "y", ts(2024, 2, 1))],
                                  "k int, attr string, eff timestamp_ntz")
    img, late, rejects = D.scd2_apply(dim, batch, ["k"], ["attr"], "eff")
    assert rows(img, "k", "attr", "is_current") == sorted(
        [(1, "a", False), (1, "x", True), (2, "b", None), (None, "c", True), (3, "d", False)], key=repr)
    assert late.count() == 0 and rows(rejects, "attr") == [("y",)]
    built = D.scd2_build(batch, ["k"], ["attr"], "eff")
    assert built.dim.count() == 1 and rows(built.rejects, "attr") == [("y",)]


def test_gaps_of_null_keys_do_not_depend_on_the_bucket(spark):
    ts = dt.datetime
    dim = spark.createDataFrame(
        [(None, ts(2024, 1, 1), ts(2024, 1, 5), False), (None, ts(2024, 1, 9), ts(9999, 12, 31), True),
         (1, ts(2024, 1, 1), ts(2024, 1, 5), False), (1, ts(2024, 1, 5), ts(9999, 12, 31), True),
         (2, None, ts(2024, 1, 5), False), (2, ts(2024, 1, 6), ts(9999, 12, 31), True)],
        "k int, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    plain = rows(D.version_gaps(dim, ["k"], bucket=None))
    assert len(plain) == 2
    for bucket in ("day", "month", "hour"):
        assert rows(D.version_gaps(dim, ["k"], bucket=bucket)) == plain
    for bucket in ("day", None):
        got = {r["check_name"]: r["status"] for r in C.check_scd2(dim, ["k"], bucket=bucket).collect()}
        assert got["No date gaps"] == "FAIL"


def test_load_batch_leaves_closed_files_alone(spark):
    from loadworks.session import scratch_database, scratch_scope
    from loadworks.sources.sinks import publish
    h = _hist(spark).filter(F.col("k").isNotNull())
    full = D.scd2_build(h, ["k"], ["attr"], "eff").dim
    with scratch_scope(spark):
        name = f"{scratch_database(spark)}.dim"
        publish(D.scd2_build(h.filter("eff < timestamp'2024-01-04'"), ["k"], ["attr"], "eff").dim, name, ["is_current"])
        files = lambda: {r[0] for r in spark.table(name).filter("not is_current")
                         .select("_metadata.file_path").distinct().collect()}
        before = files()
        D.load_batch(name, h.filter("eff >= timestamp'2024-01-04'"), ["k"], ["attr"], "eff")
        assert before and before <= files()
        assert rows(spark.table(name).select(*full.columns)) == rows(full)


def test_hot_key_buckets_match_plain_window(spark):
    n = 3000
    h = spark.range(n).select(F.lit(7).alias("k"),
                              (F.col("id") % 3).cast("string").alias("attr"),
                              (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(
                                  mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("eff"))
    a = D.scd2_build(h, ["k"], ["attr"], "eff", bucket="day").dim
    b = D.scd2_build(h, ["k"], ["attr"], "eff", bucket=None).dim
    assert rows(a) == rows(b) and a.count() == n


# ------------------------------------------------------------------ checks

def test_check_multi_join_statuses(spark):
    main = spark.createDataFrame([(i,) for i in range(4)], "id int")
    tgt = spark.createDataFrame([(0, None, "x", None), (1, None, "x", None), (2, None, "x", None),
                                 (3, "v", "x", None)], "id int, a string, b string, c string")
    res = {r["check_name"]: r["status"] for r in
           C.check_multi_join(main, tgt, ["a", "b", "c"], ["id", "load_ts"]).collect()}
    assert res == {"Row count match": "PASS", "Lookup a": "WARN", "Lookup b": "PASS",
                   "Lookup c": "FAIL", "Audit col id": "PASS", "Audit col load_ts": "FAIL"}


def test_check_file_ingestion_leak_and_skip(spark):
    t = spark.createDataFrame([("TRAILER 5",), ("data",), ("h|x",)], "c string")
    res = {r["check_name"]: r["status"] for r in C.check_file_ingestion(t, t, 3).collect()}
    assert res["Target count matches expected"] == "PASS"
    assert res["No header/footer leakage"] == "WARN"
    assert res["Partitions present"] == "SKIP"
    nums = spark.createDataFrame([(1,)], "n int")
    res2 = {r["check_name"]: r["status"] for r in C.check_file_ingestion(nums, nums, 5).collect()}
    assert res2["No header/footer leakage"] == "SKIP" and res2["Target count matches expected"] == "FAIL"


def test_run_suite_unknown_falls_back(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = C.run_suite("something_else", tables={"t": df})
    assert {r["check_name"] for r in out.collect()} == {"t has rows", "t schema non-empty"}


def test_control_file_check(spark):
    lines = spark.createDataFrame([
        ("f1", 1, "000|HDR"), ("f1", 2, "001|1|a|b"), ("f1", 3, "001|2|a|b"), ("f1", 4, "000|2"),
        ("f2", 1, "000|HDR"), ("f2", 2, "001|1|a"), ("f2", 3, "000|3")],
        "file string, line_no long, line string")
    res = {r["file"]: r["status"] for r in C.check_control_file(lines, "|", 4).collect()}
    assert res == {"f1": "PASS", "f2": "FAIL"}


def test_null_profile_percent(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "a int")
    r = C.null_profile(df).collect()[0]
    assert r["nulls"] == 2 and r["null_pct"] == Decimal("66.67")


# ------------------------------------------------------------------ audit

def test_audit_diff_and_report(spark):
    a = AU.audit_open(spark, "j", "p", "s", "t", "x", "2024-01-01 00:00:00", pos_dt="2024-01-01")
    assert a.columns == AU.AUDIT_COLUMNS and a.collect()[0]["END_TMS"] == "9999-12-31 23:59:59"
    rec = a.withColumn("TTL_REC_SRC", F.lit("5.00")).withColumn("TTL_REC_TGT", F.lit("5"))
    assert AU.reconcile_report(rec).collect()[0]["rec_match"] is True
    bad = rec.withColumn("TTL_REC_SRC", F.lit("n/a"))
    assert AU.audit_diff(bad).collect()[0]["status"] == "unparsable"


def test_inventory_diff_rules(spark):
    cols = "table_name string, column_name string, data_type string, is_partition boolean, object_type string"
    src = spark.createDataFrame([("t1", "a", "int", True, "table"), ("t1", "b", "int", False, "table"),
                                 ("t2", "a", "int", False, "table"), ("v1", "a", "int", False, "view")], cols)
    out = spark.createDataFrame([("T1", "A", "bigint", False, "table"), ("t1", "c", "int", False, "table"),
                                 ("v1", "z", "int", False, "view")], cols)
    got = {(r["issue"], r["table_name"], r["column_name"]) for r in AU.diff_inventory(src, out).collect()}
    assert got == {("missing_table", "t2", None), ("partition_dropped", "t1", None),
                   ("type_changed", "t1", "a"), ("missing_column", "t1", "b"),
                   ("extra_column", "t1", "c")}


def test_control_union_split_roundtrip(spark):
    df = spark.createDataFrame([("A", 1, 1.5), ("A", 2, 2.25), ("B", 3, 1.0)], "g string, k int, amt double")
    u = CT.union_control_detail(df, ["g"], ["k", "amt"], "amt")
    c, d = CT.split_control_detail(u, ["g"], "k", "amt")
    res = {r["g"]: r["status"] for r in CT.reconcile_control(c, d, ["g"], "amt").collect()}
    assert res == {"A": "PASS", "B": "PASS"}
    broken = c.withColumn("ttl_rec", F.col("ttl_rec") + 1)
    assert {r["status"] for r in CT.reconcile_control(broken, d, ["g"], "amt").collect()} == {"FAIL"}


# ------------------------------------------------------------------ corpus & matching

def test_scan_rules_lines_and_multiline(spark):
    corpus = spark.createDataFrame([(1, "ok\nmail a@b.cd here\nEnd.\nNext. x.\nMore")],
                                   "doc_id int, content string")
    rules = [CO.Rule("mail", r"[a-z]+@[a-z]+\.[a-z]{2,}"),
             CO.Rule("brk", r"\.\n[A-Z]", "critical", multiline=True)]
    got = rows(CO.scan_rules(corpus, rules), "rule", "line_no")
    assert got == [("brk", 3), ("brk", 4), ("mail", 2)]


def test_statement_class_order(spark):
    df = spark.createDataFrame([("MERGE INTO a.b USING c ON x WHEN MATCHED THEN UPDATE SET y = 1",),
                                ("create table x as select 1",), ("COMPUTE INCREMENTAL STATS a.b",),
                                ("show tables",)], "sql string")
    got = [r["stmt_class"] for r in CO.classify_statements(df).collect()]
    assert got == ["UPDATE", "SELECT", "OTHER"]


def test_leftovers_skip_comments(spark):
    lines = spark.createDataFrame([(1, "kinit -kt k"), (1, "  # ssh host"), (3, "\t# kinit"), (3, "\t // ssh h"), (2, "// beeline"),
                                   (2, "hdfs  dfs -ls")], "d int, line string")
    got = rows(CO.scan_leftovers(lines, ["d"]), "d", "word")
    assert got == [(1, "kinit"), (2, "hdfs dfs")]


def test_best_match_exact_against_brute_force(spark):
    import itertools
    import random
    rnd = random.Random(7)
    vocab = [f"t{i}" for i in range(12)] + ["common"] * 6
    left = [(f"l{i}", tok) for i in range(30) for tok in set(rnd.sample(vocab, 4))]
    right = [(f"r{i}", tok) for i in range(40) for tok in set(rnd.sample(vocab, 5))]
    ldf = spark.createDataFrame(left, "id string, token string")
    rdf = spark.createDataFrame(right, "id string, token string")
    got = {r["lid"]: (r["rid"], r["overlap"]) for r in M.best_match(ldf, rdf, "jaccard").collect()}
    L = {k: {t for _, t in g} for k, g in itertools.groupby(sorted(left), key=lambda x: x[0])}
    R = {k: {t for _, t in g} for k, g in itertools.groupby(sorted(right), key=lambda x: x[0])}
    for lid, ls in L.items():
        best = min(((-len(ls & rs) / len(ls | rs), rid) for rid, rs in R.items() if ls & rs),
                   default=None)
        if best is None:
            assert lid not in got
        else:
            assert got[lid][0] == best[1]


# ------------------------------------------------------------------ sinks

def test_partition_insert_does_not_depend_on_the_session(spark):
    from loadworks.session import scratch_database, scratch_scope
    from loadworks.sources import sinks as K
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    with scratch_scope(spark):
        name = f"{scratch_database(spark)}.t"
        K.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, m string"), name, ["m"])
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        try:
            K.insert_partitions(spark.createDataFrame([(3, "b")], "k int, m string"), name)
            assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        assert rows(spark.table(name)) == [(1, "a"), (3, "b")]
        # the image may be computed from the table it replaces; no staging or backup stays
        K.publish(spark.table(name).withColumn("k", F.col("k") + 1), name, ["m"])
        assert rows(spark.table(name)) == [(2, "a"), (4, "b")]
        assert [t.name for t in spark.catalog.listTables(name.split(".")[0])] == ["t"]


def test_append_retries_conflicts_only(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from loadworks.session import scratch_database, scratch_scope
    from loadworks.sources import sinks as K
    real, calls, waits = DataFrameWriter.saveAsTable, [], []

    def flaky(self, name, **kw):
        calls.append(name)
        if len(calls) <= 2:
            raise RuntimeError("ConcurrentAppend")
        return real(self, name, **kw)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", flaky)
    conflict = lambda e: "ConcurrentAppend" in str(e)
    df = spark.createDataFrame([(1,)], "k int")
    with scratch_scope(spark):
        name = f"{scratch_database(spark)}.t"
        assert K.append_with_retry(df, name, conflict, sleep=waits.append) == 3
        assert waits == [2, 4] and spark.table(name).count() == 1
        calls.clear()
        with pytest.raises(RuntimeError):
            K.append_with_retry(df, name, lambda e: False, sleep=waits.append)
        assert len(calls) == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from loadworks import session as SS
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        SS.local_scratch("spark://host:7077")
    with SS.scratch_scope(spark):
        path = SS.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


# ------------------------------------------------------------------ files

def test_head_lines_and_sniffing_of_split_files(spark, tmp_path):
    from loadworks.sources import files as FS
    wide = "a|b|c\n" + "x" * 5000 + "|,,,,,,,,\n"           # the commas lie behind the prefix
    texts = {"soh": "a\x01b|c\n", "pipe": wide, "tab": "a\tb\r\nc\td\r\n", "comma": "a|b,c\n",
             "long": "a,b\n" + "1,2\n" * 3000}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "none").write_bytes(b"")
    conf = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        base = lambda c: F.element_at(F.split(c, "/"), -1)
        got = dict(rows(FS.sniff_delimiter(spark, str(tmp_path)).select(base("file").alias("f"), "delimiter")))
        assert got == {"soh": "soh", "pipe": "pipe", "tab": "tab", "comma": "comma", "long": "comma"}
        heads = FS.head_lines(spark, str(tmp_path), 2).select(base("file").alias("f"), "line_no", "line")
        assert ("tab", 2, "c\td") in rows(heads) and heads.filter("f = 'long'").count() == 2
        numbered = FS.number_lines(spark, str(tmp_path)).filter(base("file") == "long")
        assert [r["line_no"] for r in numbered.orderBy("line_no").collect()] == list(range(1, 3002))
    finally:
        for k, v in conf.items():
            spark.conf.set(k, v)


def test_flat_files_have_no_quoting_and_blank_lines_no_records(spark, tmp_path):
    from loadworks.sources import files as FS
    (tmp_path / "f").write_text('000|H\n001|1|"ABC|9\n\t \n001|2|x"y"|8\n000|2\n\t\n')
    flat = FS.read_flat(spark, str(tmp_path), ["o", "k", "n", "v"])
    assert ("001", "1", '"ABC', "9") in rows(flat)
    assert [r["records"] for r in FS.count_file_records(FS.number_lines(spark, str(tmp_path))).collect()] == [3]


# ------------------------------------------------------------------ round two additions

def test_many_matches_in_one_document_stay_linear(spark):
    n = 100_000
    corpus = spark.createDataFrame([(1, "A.\n" * n + "A"), (2, None)], "doc_id int, content string")
    got = CO.scan_rules(corpus, [CO.Rule("brk", r"\.\n[A-Z]", "critical", multiline=True)])
    r = got.agg(F.count("*"), F.min("line_no"), F.max("line_no"), F.countDistinct("line_no")).first()
    assert tuple(r) == (n, 1, n, n)
    cls = CO.classify_documents(corpus, [CO.Rule("a", "A")])
    assert rows(cls, "doc_id", "issues", "classification") == [(1, n + 1, "broken"), (2, 0, "clean")]
    assert CO.flag_short_wrappers(corpus, "doc_id", "A", skip=("9",)).filter("flagged is null").count() == 0


def test_statements_of_scripts(spark):
    text = ('impala-shell -q "select 1" -q \'refresh t\'\nspark.sql(f"""\n merge into x \n""")\n'
            'spark.sql("a b") ; spark.sql("  ")\nrun $2 ${1}')
    df = spark.createDataFrame([(1, text), (2, None), (3, "dbutils.widgets.get('a') $1")], "s int, content string")
    got = CO.extract_statements(df, ["s"])
    assert [r[1] for r in rows(got, "stmt_no", "sql")] == ["select 1", "refresh t", "merge into x", "a b"]
    assert rows(CO.removable_left(got, ["s"])) == [(1, "REFRESH")]
    assert rows(CO.positional_parameters(df, ["s"])) == [(1, "1,2")]


def test_resolve_prefers_aliases_and_compares_raw_scores(spark):
    wanted = spark.createDataFrame([("w", f"c{i}") for i in range(3001)] + [("x", "q"), ("a", "c1")],
                                   "table_name string, column_name string")
    # 2,000 and 2,001 of 3,001 columns: the same score at two places only if far enough rounded
    cols = spark.createDataFrame([("a_less", f"c{i}") for i in range(3000)]
                                 + [("b_more", f"c{i}") for i in range(3001)], "table_name string, column_name string")
    tables = cols.select("table_name").distinct().unionByName(spark.createDataFrame([("plain",)], "table_name string"))
    alias = spark.createDataFrame([("a", "plain"), ("a", "gone"), ("x", "gone")], "table_name string, target string")
    got = {r["wanted"]: (r["resolved"], r["how"]) for r in M.resolve_tables(wanted, tables, cols, alias).collect()}
    assert got == {"w": ("b_more", "columns"), "x": ("b_more", "widest"), "a": ("plain", "alias")}


def test_namespaces_and_samples(spark):
    from loadworks.session import scratch_database, scratch_scope
    from loadworks.sources.namespaces import Namespaces
    with scratch_scope(spark):
        ns = Namespaces(spark, scratch_database(spark), scratch_database(spark))
        assert AU.table_counts_in(spark, ns.source).count() == 0
        spark.range(3).write.saveAsTable(f"{ns.source}.t")
        spark.range(2).write.saveAsTable(f"{ns.target}.job_rcncl")
        assert ns.read_source("t").count() == 3
        assert rows(AU.table_counts_in(spark, ns.source)) == [("t", 3)]
        assert AU.table_counts_in(spark, ns.target).count() == 0
        assert ns.first_readable(f"{ns.target}.t", f"{ns.source}.t").count() == 3
        with pytest.raises(LookupError):
            ns.first_readable(f"{ns.target}.t")
    samples = C.generic_samples({"r": spark.range(9), "e": spark.range(0)}, 2)
    assert rows(samples) == [("r", '{"id":0}'), ("r", '{"id":1}')]


def test_dates_and_rejects(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-13-01",), (" ",), (None,)], "d string")
    bad = df.agg(S.reject_count("d", S.date_text_to_timestamp("d"))).first()[0]
    assert bad == 1
    r = spark.range(1).select(S.current_dt("2024-02-03"), F.date_trunc("month", S.current_dt("2024-02-03")),
                              S.current_dt() == F.current_date()).first()
    assert r[0] == dt.date(2024, 2, 3) and r[1].date() == dt.date(2024, 2, 1) and r[2]


def test_unique_lookup_is_not_reduced(spark):
    main = spark.createDataFrame([(1, 10)], "id int, k int")
    lk = spark.createDataFrame([(10, "a")], "key int, v string")
    out = enrich(main, [Lookup(lk, {"k": "key"}, ["v"], unique=True)])
    assert rows(out, "id", "v") == [(1, "a")]
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
