"""The registered queries over small tables: all contract columns against brute force."""

import hashlib

import pytest

from loadworks.llm import queries
from tests.llm import brute
from tests.llm.test_copies import synthetic


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def rows():
    passage = " ".join(f"term{k}" for k in range(40))
    return synthetic(11) + [(2000, passage), (2001, f"x {passage} y"), (2002, f"see {passage[:60]} Alpha beta")]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(d, t, "s", 7) for d, t in rows], "doc_id long, text string, spans string, n_words int") \
        .repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items(), "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def items():
    passage = " ".join(f"term{k}" for k in range(5, 30))
    return [("b1", passage), ("b2", "alpha beta"), (None, "x term0"), ("b3", None), ("b4", "")]


def test_word_dedup(spark, rows, folder):
    got = queries.op8_word_dedup(spark, folder).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} \
        == {d: (n, gone, sha(kept.encode())) for d, (n, gone, kept) in brute.word_dedup(rows, 20).items()}
    assert len(got) == len(rows)


def test_byte_dedup(spark, rows, folder):
    got = queries.op5_byte_dedup(spark, folder).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} \
        == {d: (n, n - len(kept), spans, sha(kept)) for d, (n, spans, kept) in brute.byte_dedup(rows, 50).items()}
    assert len(got) == len(rows)


def test_decontamination(spark, rows, folder):
    got = queries.op2_decontaminate(spark, folder).collect()
    want = brute.contamination(rows, [(i, t) for i, t in items() if i], 10)
    everything = brute.contamination(rows, items(), 10)  # an item without id hits, but has no name
    for r in got:
        n, hit, _ = everything[r["doc_id"]]
        names = want[r["doc_id"]][2]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) \
            == (n, len(hit), len(names), sha(",".join(names).encode()), bool(hit))
    assert len(got) == len(rows)
