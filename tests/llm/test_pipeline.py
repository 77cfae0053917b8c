"""The pipeline's stages against brute force, on odd rows and on the documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from loadworks.llm.components import stored
from tests.llm import brute

PASSAGE = " ".join(f"passage{i}" for i in range(60))
ITEM = "what is the exact answer to this very long benchmark question of ours please"


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """The documents of the smallest table with cases planted behind them."""
    at = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = docs.where("length(text) > 2000").orderBy("doc_id").first()["text"]
    words = plain.split()
    rows = [(10_001, None), (10_002, ""), (10_003, "1234 !!"), (10_004, plain), (10_005, plain.replace(words[40], "changed", 1)),
            (10_006, "First of all " + PASSAGE), (10_007, PASSAGE + " and then some more"), (10_008, PASSAGE),
            (10_009, "Some talk. " + ITEM.upper() + " Other talk."), (10_010, ITEM), (10_010, ITEM)]
    planted = spark.createDataFrame([(d, t, "en", "planted", 0) for d, t in rows],
                                    "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(planted).withColumn("score", F.lit("kept")).repartition(3).write.parquet(f"{at}/documents.parquet")
    items = spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string")
    items.write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_take_effect_and_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = stored(stage(spark, docs, folder), "stage")
        assert docs.columns == columns and docs.where("score <> 'kept'").count() == 0
        old, new = texts(before), texts(docs)
        assert set(new) <= set(old)
        if stage is cp.language:
            assert set(old) - set(new) == {10_001, 10_002, 10_003}
        elif stage is cp.near_dedup:
            label = brute.near_components(list(old.items()), 5, (80, 100))
            assert set(new) == {d for d, (_, c) in label.items() if c == d}
            assert docs.where("doc_id = 10010").count() == 1
        elif stage is cp.substring_dedup:
            want = brute.word_dedup(list(old.items()), 20)
            assert new == {d: (kept if gone else old[d]) for d, (n, gone, kept) in want.items() if not n or gone < n}
            assert sum(PASSAGE in t for t in new.values()) == 1
        else:
            hit = brute.contamination(list(old.items()), [(1, ITEM)], 10)
            assert {d for d in new if new[d] != old[d]} | (set(old) - set(new)) == {d for d, h in hit.items() if h[1]}
            assert not any(h[1] for h in brute.contamination(list(new.items()), [(1, ITEM)], 10).values())
    rows = cp.packed(spark, docs, folder).collect()
    assert {r["doc_id"] for r in rows} == set(texts(docs))


def test_run_over_an_empty_table(spark, folder, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_run_over_the_documents(spark, sf):
    rows = cp.run(spark, sf)
    assert rows.count() > 0
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns)
