"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents.  What a stage removes is stated in its
docstring; everything else passes through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadworks.llm import decontaminate, lang_id, near_dup, packing, word_dedup
from loadworks.llm.columns import ready
from loadworks.llm.components import small, stored
from loadworks.session import scratch_path

MIN_LANGUAGE_SCORE = 0.3  # share of a text's n-grams that its language explains, at least ...
JUDGED_GRAMS = 40         # ... of texts with so many n-grams; shorter ones are not judged by it
SHINGLE, SHARE = 5, (80, 100)


def _flat(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ... so that no operator's column clashes; name to new name."""
    ready(docs.sparkSession)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _changed(docs: DataFrame, names: dict[str, str], text: Column, changed: Column) -> DataFrame:
    """The columns of documents, with the new text and its length where it changed."""
    new = F.when(changed, text).otherwise(F.col(names["text"]))
    columns = {"text": new}
    if "n_chars" in names:
        columns["n_chars"] = F.when(changed, F.length(text).cast("long")).otherwise(F.col(names["n_chars"]))
    return docs.select(*[columns.get(c, F.col(n)).alias(c) for c, n in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language explains too few of their n-grams
    (if they are long enough to tell)."""
    flat, names = _flat(docs)
    model = lang_id.fit(flat, names["doc_id"], names["text"], names["lang"])
    known = lang_id.predict(flat, model, names["text"])
    kept = known.where((F.col("lang_pred") != lang_id.UNKNOWN) & ((F.col("score") >= MIN_LANGUAGE_SCORE)
                                                                 | (F.col("n_grams") < JUDGED_GRAMS)))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of near copies, the document with the smallest id."""
    flat, names = _flat(docs)
    found = stored(near_dup.near_duplicates(docs, shingle=SHINGLE, share=SHARE), "near")
    gone = found.where("id <> component_id").select("id").distinct()
    repeated = found.groupBy("id").count().where("id is not null and count > 1").select("id")
    own = F.col(names["doc_id"]) == F.col("id")
    left = flat.join(small(gone), own, "left_anti")
    if repeated.limit(1).count():  # rows of one id with the same text are copies as well
        again = left.join(small(repeated), own, "left_semi").dropDuplicates([names["doc_id"], names["text"]])
        left = left.join(small(repeated), own, "left_anti").unionByName(again)
    return left.select(*[F.col(n).alias(c) for c, n in names.items()])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of repeated windows; drops documents of which nothing is left."""
    flat, names = _flat(docs)
    cut = word_dedup.dedup_words(flat, names["doc_id"], names["text"])
    cut = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return _changed(cut, names, F.col("kept"), F.col("n_removed") > 0)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes benchmark passages from texts; drops documents that were nothing else."""
    flat, names = _flat(docs)
    text = names["text"]
    cut = decontaminate.clean(flat.withColumn("before", F.col(text)),
                              spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text)
    cut = cut.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    hit = F.col("n_hit") > 0
    return _changed(cut.withColumn("after", F.col(text)).withColumn(text, F.col("before")), names,
                    F.col("after"), hit)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    ready(spark)
    return (packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
            .withColumnRenamed("id", "doc_id"))


STAGES = [("language id", language), ("near dedup", near_dedup), ("substring dedup", substring_dedup),
          ("decontamination", decontaminated), ("packing", packed)]

# The stages learn, hash and tokenise: SQL cannot express them; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
