"""The registered queries of this package and their oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadworks.llm import (align, ann, byte_dedup, decontaminate, lang_id, license_scan, merkle, mixing,
                           near_dup, packing, token_count, warc, word_dedup)
from loadworks.llm.columns import ready
from loadworks.llm.oracles import ORACLE  # noqa: F401 - part of this module's interface
from loadworks.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables; the session gets Arrow batches of bounded size."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fitted on the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    found = decontaminate.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                               _table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    counted = token_count.count_tokens(_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > 2048).alias("over_limit"))


def op5_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat a smaller document."""
    found = byte_dedup.dedup_bytes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families named in each document."""
    docs = _table(spark, sf_dir, "documents")
    named = (license_scan.scan(docs, license_scan.fit(docs)).groupBy("id")
             .agg(F.count("*").alias("n_paragraphs"), F.array_sort(F.collect_set("family")).alias("families"),
                  F.min("probability").alias("probability"))
             .withColumnRenamed("id", "named_id"))
    return (docs.select("doc_id").join(named, F.col("doc_id").eqNullSafe(F.col("named_id")), "left")
            .select("doc_id", F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
                    F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
                    F.round("probability", 6).alias("probability")))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_word_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier window."""
    found = word_dedup.dedup_words(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept", 256).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the archives that hold the pages."""
    path = scratch_path(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").alias("refers_to"), "checked")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed corpus."""
    return (packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
            .withColumnRenamed("id", "doc_id"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by source, and the proofs checked against tampered texts."""
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = merkle.leaf(*fields, F.replace("text", F.lit("\n"), F.lit("")))
    rows = docs.select("doc_id", "source", merkle.leaf(*fields, F.col("text")).alias("leaf"),
                       F.when(tampered, found).alias("found"))
    made = merkle.manifest(rows, "source", "doc_id")
    folded = merkle.fold(F.coalesce("found", "leaf"), F.col("proof"))
    return made.select("doc_id", "leaf", "subroot", "root",
                       merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    found = align.links(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontaminate, op3_near_duplicates, op4_token_count, op5_byte_dedup,
    op6_license_scan, op7_nearest, op8_word_dedup, op9_warc, op10_pack, op11_merkle_manifest,
    op12_token_alignment, op13_mixing)}
