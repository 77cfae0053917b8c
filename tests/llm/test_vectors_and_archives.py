"""Nearest neighbours against brute force; WARC round trips."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadworks.llm import ann, warc
from loadworks.session import scratch_path


def exact(rows, every, n):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        distance = np.sqrt(np.square(x - x[q]).sum(1))
        order = [k for k in np.lexsort((ids, distance)) if ids[k] != ids[q]][:n]
        out[int(ids[q])] = [(int(ids[k]), float(distance[k])) for k in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_against_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = exact([(r["vec_id"], r["embedding"]) for r in vectors.collect()], 20, 10)
    got = by_query(ann.nearest(vectors, F.col("vec_id") % 20 == 0, least=1200).collect())
    assert set(got) == set(want)
    assert np.mean([len(set(dict(got[q])) & set(dict(want[q]))) / 10 for q in want]) >= 0.9


def test_dealt_queries_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "ASKS", 7)
    monkeypatch.setattr(ann, "BLOCK", 20)
    got = by_query(ann.nearest(df, F.col("vec_id") % 4 == 0, candidates=1.0).collect())
    want = exact(rows, 4, 10)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}


def test_whole_walk_is_exact_with_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(300)]
    rows = [(i, v) for i, v in rows if any(v)] + [(1000 + i, [1.0, 0.0, 0.0, 2.0, 0.0]) for i in range(100)]
    odd = [(5000, None), (5100, [0.0] * 5), (5200, [1.0, None, 0.0, 0.0, 0.0]), (5300, [float("nan")] * 5),
           (5400, [float("inf")] * 5), (5500, [1.0])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + odd],
                               "vec_id long, embedding array<double>, key int, rank int")
    want = exact(rows, 10, 10)
    got = by_query(ann.nearest(df, F.col("vec_id") % 10 == 0, candidates=1.0).collect())
    assert set(got) == set(want)
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in near])
    assert ann.nearest(df.where("false"), F.lit(True)).count() == 0
    assert ann.nearest(df.where("vec_id = 1000"), F.lit(True)).count() == 0


def pages(spark):
    inner = "x" * 2000 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(i, f"http://h/{i}", f"p{i} \r\n" * i) for i in range(60)]
    rows += [(100, None, None), (101, "u\r\nx", inner), (102, "u", inner), (103, "u", "z\nWARC/1.1\r\n"),
             (104, "u", "\r\n"), (105, "v", "\r\n\r\n" + "q" * 1500 + "\r\n"), (106, "v", "é" * 3000),
             (107, "v", "é" * 3000), (108, "v", "é" * 3000), (108, "v", "é" * 3000), (109, "w", "WARC/1.0\r\n\r\n")]
    return rows, spark.createDataFrame([(i, u, h, "x") for i, u, h in rows],
                                       "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("block, part", [("128m", None), ("700", None), ("128m", 300), ("700", 1000)])
def test_archives_round_trip_wherever_they_are_split(spark, monkeypatch, block, part):
    if part:
        monkeypatch.setattr(warc, "OWNER_BYTES", part)
    rows, df = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write(df.coalesce(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert all(r["checked"] for r in got)
    largest = {101: 102, 106: 108, 107: 108}
    want = [(i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
             "revisit" if i in largest else "response", largest.get(i)) for i, _, h in rows]
    have = [(r["page"], r["payload_bytes"], r["digest"], r["type"], r["refers"]) for r in got]
    assert sorted(map(str, have)) == sorted(map(str, want))


def test_empty_archive(spark):
    _, df = pages(spark)
    path = scratch_path(spark, "warc-test")
    warc.write(df.where("false"), path)
    assert warc.read(spark, path).count() == 0


def test_a_damaged_header_ends_the_chain(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(good + good.replace(b"2", b"x") + good)
    assert [r["at"] for r in warc.read(spark, str(tmp_path)).collect()] == [0]
