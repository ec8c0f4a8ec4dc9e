from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as entry
from storelift.llm import stages
from tests.llm.test_decontaminate import containment
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_one_by_one(spark):
    """Each stage on its predecessor's rows, against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    recognised = stages.language_id(spark, docs, SF)
    assert recognised.columns == columns and recognised.count() >= 0.99 * docs.count()
    rows = [tuple(r) for r in recognised.select("doc_id", "text").collect()]
    unique = stages.near_dedup(spark, recognised, SF)
    assert unique.columns == columns
    assert sorted(r.doc_id for r in unique.collect()) == sorted(d for d, (_, c) in brute(rows).items() if d == c)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    clean = stages.decontamination(spark, unique, SF)
    assert clean.columns == columns
    want = sorted(r.doc_id for r in unique.collect() if all(containment(r.text, i.text) < 0.75 for i in items))
    assert sorted(r.doc_id for r in clean.collect()) == want
    mixed = stages.mixing_to_weights(spark, clean, SF)
    assert mixed.columns == columns and 0 < mixed.count() < clean.count()
    last = stages.token_ids(spark, mixed, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in mixed.collect())


def test_run(spark):
    rows = sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: r.doc_id)
    assert rows and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


def test_odd_and_no_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        docs.collect()
