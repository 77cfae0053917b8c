"""Loads that die and are run again, appends that are repeated, files that stay, readers during a publication."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from loadworks.operators import apply as A
from loadworks.operators import scd as D
from loadworks.operators import touched as T
from loadworks.plans.scd_queries import stops_at
from loadworks.session import scratch_database, scratch_path, scratch_scope
from loadworks.sources import sinks as K
from loadworks.sources.folders import Folder
from loadworks.sources.journal import Conflict, Journal, append_once

STEPS = ["staged", "committed", "moved", "removed", "noted", "done"]


@pytest.fixture(autouse=True)
def scope(spark):
    with scratch_scope(spark):
        yield


def numbers(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("k").collect())


def stamps(spark, path):
    """Data files and when they were written."""
    folder = Folder(spark, path)
    return {f: folder._fs.getFileStatus(folder._at(f)).getModificationTime() for f in folder.data_files()}


def table_of(spark, n=1000, files=10):
    path = scratch_path(spark, "table")
    spark.range(0, n, 1, files).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).write.parquet(path)
    return path


# ------------------------------------------------------------------ journal

@pytest.mark.parametrize("death", STEPS)
def test_a_replacing_load_that_dies_is_done_or_undone(spark, death):
    path = table_of(spark, 100, 4)
    before = Folder(spark, path).data_files()
    new = spark.range(100, 120).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    with pytest.raises(InterruptedError):
        Journal(spark, path, stops_at(death)).change("load", new, before, base=0)
    if death == "staged":
        assert numbers(spark, path) == list(range(100))  # readers see nothing of it
    made = Journal(spark, path).change("load", new, before, base=0)
    assert (made.removed, made.repeated) == (4, death != "staged")
    assert numbers(spark, path) == list(range(100, 120))
    assert [n for n in Folder(spark, path).names("_journal") if n.startswith("stage-")] == []
    again = Journal(spark, path).change("load", new, before, base=0)
    assert again.repeated and numbers(spark, path) == list(range(100, 120))


@pytest.mark.parametrize("death", STEPS)
def test_another_load_finishes_what_a_committed_one_left(spark, death):
    path = table_of(spark, 10, 2)
    first = spark.range(10, 20).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    with pytest.raises(InterruptedError):
        Journal(spark, path, stops_at(death)).change("first", first)
    append_once(spark.range(50, 55).select(F.col("id").alias("k"), F.lit(2).cast("long").alias("v")), path, "second")
    done = [] if death == "staged" else list(range(10, 20))
    assert numbers(spark, path) == sorted([*range(10), *done, *range(50, 55)])
    left = Journal(spark, path).clean()
    assert len(left) == (1 if death == "staged" else 0)


def test_an_append_is_applied_once(spark):
    path = table_of(spark, 10, 1)
    df = spark.range(3).select((F.col("id") + 100).alias("k"), F.col("id").alias("v"))
    assert not append_once(df, path, "a").repeated
    assert append_once(df, path, "a").repeated and append_once(df, path, "a").number == 1
    assert append_once(df, path, "b").number == 2
    assert numbers(spark, path) == sorted([*range(10), *[100, 101, 102] * 2])


def test_appends_side_by_side_are_all_there_once(spark):
    path = table_of(spark, 1, 1)
    errors = []

    def work(load):
        try:
            append_once(spark.range(1).select((F.col("id") + int(load)).alias("k"), F.col("id").alias("v")), path, load)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    loads = [threading.Thread(target=work, args=(str(100 + n % 4),)) for n in range(8)]  # every load twice
    for t in loads:
        t.start()
    for t in loads:
        t.join()
    assert errors == [] and numbers(spark, path) == [0, 100, 101, 102, 103]


def test_a_replacing_load_that_read_an_older_state_conflicts(spark):
    path = table_of(spark, 10, 2)
    journal, files = Journal(spark, path), Folder(spark, path).data_files()
    base = journal.version()
    append_once(spark.range(1).select((F.col("id") + 77).alias("k"), F.col("id").alias("v")), path, "between")
    with pytest.raises(Conflict) as caught:
        journal.change("late", None, files, base=base)
    assert K.is_concurrent_append(caught.value) and K.is_concurrent_append(Exception("io.X.ConcurrentAppendException: files"))
    assert not K.is_concurrent_append(ValueError("no"))
    assert numbers(spark, path) == sorted([*range(10), 77])
    assert [n for n in Folder(spark, path).names("_journal") if n.startswith("stage-")] == []
    journal.change("late", None, files, base=journal.version())
    assert numbers(spark, path) == [77]


def test_retry_recognises_a_conflict_by_itself(spark, monkeypatch):
    name = f"{scratch_database(spark)}.t"
    df, waits, tries = spark.range(2), [], []
    real = type(df.write).saveAsTable

    def save(self, *a, **k):
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("ConcurrentAppendException")
        return real(self, *a, **k)

    monkeypatch.setattr(type(df.write), "saveAsTable", save)
    assert K.append_with_retry(df, name, sleep=waits.append) == 3 and waits == [2, 4]


def test_names_with_odd_characters(spark):
    path = scratch_path(spark, "odd")
    rows = spark.createDataFrame([(1, "a b"), (2, "x%y"), (3, "é{1}"), (4, None)], "k long, p string")
    rows.write.partitionBy("p").parquet(path)
    made = T.upsert_files(spark, path, spark.createDataFrame([(3, "é{1}"), (1, "a b"), (9, "[z]")], "k long, p string"),
                          ["k"], partition_by=["p"])
    assert made.change.removed == 2
    assert sorted((r["k"], r["p"]) for r in spark.read.parquet(path).collect() if r["p"]) == [
        (1, "a b"), (2, "x%y"), (3, "é{1}"), (9, "[z]")]


# ------------------------------------------------------------------ dimension loads

HISTORY = [("a", "x", 1), ("a", "y", 3), ("b", "x", 2), ("c", "z", 2)]
BATCH = [("a", "w", 5), ("a", "w", 6), ("b", "x", 6), ("d", "n", 5), ("c", "q", 2), (None, "q", 5)]


def events(spark, rows):
    return spark.createDataFrame(rows, "k string, attr string, d int").select(
        "k", "attr", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, d)").alias("eff"))


@pytest.mark.parametrize("death", [None, *STEPS])
def test_a_dimension_load_that_dies_is_completed_by_running_it_again(spark, death):
    name = f"{scratch_database(spark)}.dim"
    K.publish(D.scd2_build(events(spark, HISTORY), ["k"], ["attr"], "eff").dim, name, ["is_current"])
    want = D.scd2_apply(D.scd2_build(events(spark, HISTORY), ["k"], ["attr"], "eff").dim, events(spark, BATCH),
                        ["k"], ["attr"], "eff").image
    want = sorted(map(str, want.select(sorted(want.columns)).collect()))
    load = lambda **kw: D.load_batch(name, events(spark, BATCH), ["k"], ["attr"], "eff", load_id="b1", **kw)
    if death:
        with pytest.raises(InterruptedError):
            load(step=stops_at(death))
        spark.catalog.refreshTable(name)
    else:
        loaded = load()
        assert [r["k"] for r in loaded.late.collect()] == ["c"] and loaded.rejects.count() == 1
    done = load()
    assert done.change.repeated == (death not in (None, "staged") or death is None)
    shown = spark.table(name)
    assert sorted(map(str, shown.select(sorted(shown.columns)).collect())) == want


# ------------------------------------------------------------------ touched files

def test_files_without_a_hit_keep_name_and_time(spark):
    path = table_of(spark)  # 10 files of 100 keys each
    before = stamps(spark, path)
    batch = spark.createDataFrame([(205, 50), (210, 51), (2000, 52), (None, 53)], "k long, v long")
    made = T.upsert_files(spark, path, batch, ["k"])
    after = stamps(spark, path)
    assert made.change.removed == 1 and made.files == 10
    assert len(set(before) - set(after)) == 1 and {f: t for f, t in after.items() if f in before}.items() <= before.items()
    want = A.upsert(spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")), batch, ["k"]).image
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, want.collect()))


def test_update_delete_and_replace_touch_only_their_files(spark):
    path = table_of(spark)
    source = spark.createDataFrame([(150, None), (151, 9), (5000, 1)], "k long, w long")
    assert T.update_files(spark, path, source, ["k"], {"v": "w"}).change.removed == 1
    assert T.delete_files(spark, path, spark.range(300, 305).select(F.col("id").alias("k")), ["k"]).change.removed == 1
    new = spark.createDataFrame([(900, -1)], "k long, v long")
    assert T.replace_files(spark, path, new, F.col("k") >= 900).change.removed == 1
    got = dict(map(tuple, spark.read.parquet(path).select("k", "v").collect()))
    want = {k: k % 7 for k in range(900) if not 300 <= k < 305} | {150: None, 151: 9, 900: -1}
    assert got == want


def test_a_batch_without_hits_or_rows_touches_nothing(spark):
    path = table_of(spark, 100, 4)
    before = stamps(spark, path)
    empty = spark.createDataFrame([], "k long, v long")
    assert T.upsert_files(spark, path, empty, ["k"]).change.removed == 0
    assert T.delete_files(spark, path, empty, ["k"]).change.removed == 0
    assert T.delete_files(spark, path, spark.createDataFrame([(None,)], "k long"), ["k"]).change.removed == 0
    assert T.upsert_files(spark, path, spark.createDataFrame([(500, 1)], "k long, v long"), ["k"]).change.removed == 0
    after = stamps(spark, path)
    assert before.items() <= after.items() and numbers(spark, path) == [*range(100), 500]


def test_the_key_scan_is_pruned_and_narrow(spark):
    path = table_of(spark)
    table = spark.read.parquet(path)
    pruned = T.key_range(spark.createDataFrame([(5, 1), (9, 1)], "k long, v long"), ["k"])
    plan = table.select("k", "_metadata.file_path").filter(pruned)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,5)" in plan and "LessThanOrEqual(k,9)" in plan
    assert "ReadSchema: struct<k:bigint>" in plan


@pytest.mark.parametrize("death", STEPS)
def test_an_upsert_that_dies_is_completed_by_running_it_again(spark, death):
    path = table_of(spark, 100, 4)
    batch = spark.createDataFrame([(5, 50), (99, 51), (200, 52)], "k long, v long")
    run = lambda **kw: T.upsert_files(spark, path, batch, ["k"], load_id="u1", **kw)
    with pytest.raises(InterruptedError):
        run(step=stops_at(death))
    assert run().change.repeated == (death != "staged") and run().change.repeated
    got = dict(map(tuple, spark.read.parquet(path).collect()))
    assert got == {k: k % 7 for k in range(100)} | {5: 50, 99: 51, 200: 52}


# ------------------------------------------------------------------ publication

def test_readers_during_publications_see_whole_versions(spark):
    name = f"{scratch_database(spark)}.shown"
    image = lambda n: spark.range(0, 200, 1, 4).select("id", F.lit(n).alias("version"))
    K.publish_version(image(0), name, keep=4)
    stop, seen, errors = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.table(name).agg(F.count("*"), F.min("version"), F.max("version")).first()))
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 8):
        K.publish_version(image(n), name, keep=4)
    stop.set()
    reader.join()
    assert errors == [] and seen and all(n == 200 and low == high for n, low, high in seen)
    assert K.published_version(spark, name) == 8


def test_a_pinned_reader_keeps_its_version_and_schemas_may_change(spark):
    name = f"{scratch_database(spark)}.shown"
    K.publish_version(spark.range(3).select("id", F.lit("a").alias("p")), name, ["p"])
    begun = K.pinned(spark, name)
    K.publish_version(spark.createDataFrame([("x", 1.5)], "other string, amount double"), name)
    assert begun.count() == 3 and spark.table(name).columns == ["other", "amount"]
    for _ in range(4):
        K.publish_version(spark.table(name), name, keep=2)
    folder = K._versions(spark, name)
    assert len(folder.names()) == 2 and spark.table(name).count() == 1


def test_a_publication_that_dies_shows_the_old_version(spark, monkeypatch):
    name = f"{scratch_database(spark)}.shown"
    K.publish_version(spark.range(3), name)
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        K.publish_version(broken, name)
    assert spark.table(name).count() == 3
    K.publish_version(spark.range(4), name)
    assert spark.table(name).count() == 4


def test_first_readable_passes_over_missing_and_broken_tables(spark):
    db = scratch_database(spark)
    path = scratch_path(spark, uuid.uuid4().hex)
    spark.range(2).write.parquet(path)
    spark.sql(f"CREATE TABLE {db}.broken (id BIGINT) USING parquet LOCATION '{path}'")
    folder = Folder(spark, path)
    for f in folder.data_files():
        folder.delete(f)
        folder.create(f, "not parquet")
    spark.range(3).write.saveAsTable(f"{db}.good")
    name, df = K.first_readable(spark, [f"{db}.none", f"{db}.broken", f"{db}.good"])
    assert name == f"{db}.good" and df.count() == 3
    with pytest.raises(ValueError):
        K.first_readable(spark, [f"{db}.none"])
