"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import annforest, codebooks, decontaminate, hardneg, htmlmain, langid, linededup, lm, mixing, neardup, sharding, simhash, tokenfile
from .common import read_table as _read_table
from .common import ship_package
from .oracle import ORACLE_SQL  # noqa: F401


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return _read_table(spark, sf_dir, name)


def op1_shard_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.histogram_sort(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annforest.nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenfile.encode_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaked_items(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.withColumn("probability", F.round("probability", 9))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.select("vec_id", "embedding", label.alias("label")))


def op12_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.encode(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_shard_histogram": op1_shard_histogram,
    "op2_nearest_vectors": op2_nearest_vectors,
    "op3_token_ids": op3_token_ids,
    "op4_main_text": op4_main_text,
    "op5_language_id": op5_language_id,
    "op6_near_duplicates": op6_near_duplicates,
    "op8_lm_score": op8_lm_score,
    "op9_decontamination": op9_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_simhash_trie": op12_simhash_trie,
    "op13_laesa_codes": op13_laesa_codes,
}
