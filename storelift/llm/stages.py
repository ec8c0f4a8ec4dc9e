"""Pipeline stages: documents in, documents (at last token digests) out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, mixing, neardup, tokenfile
from .common import read_table, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised (operator 5)."""
    ship_package(spark)
    return langid.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (operator 6)."""
    ship_package(spark)
    return neardup.unique_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item (operator 9)."""
    ship_package(spark)
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by their cell's calibrated probability (operator 10)."""
    return mixing.sample(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns their digest per document (operator 3)."""
    import public_tokenizers

    ship_package(spark)
    return tokenfile.encode_digest(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
