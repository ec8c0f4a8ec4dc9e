"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's documents.
All but the last return the columns of ``documents``; the last returns one row
per remaining document, read back from the token files.

``ORACLE_SQL`` is None: SQL cannot express the classifier, the tokenizer or the
files.  The stages are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelift.llm import stages
from storelift.session import stored

STAGES = [
    ("language ID", stages.language_id),
    ("near-dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("mixing", stages.mixing_to_weights),
    ("token ids", stages.token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
