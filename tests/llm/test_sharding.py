from __future__ import annotations

import zlib

from storelift.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def test_bytes_law_slots_and_groups(spark):
    rows = queries.op1_shard_histogram(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert sorted(rows.doc_id) == sorted(docs.doc_id)
    want = {d: (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in zip(docs.doc_id, docs.text)}
    assert all(want[d] == (s, c) for d, s, c in zip(rows.doc_id, rows["size"], rows.text_crc32))
    sums = rows.groupby("shard")["size"].sum()
    largest = rows["size"].max()
    assert len(sums) == 16 and (sums - sums.mean()).abs().max() <= largest
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert rows.grown_shard.isna().all() and set(rows.law) == {"bytes"}


def test_hot_text_spreads(spark):
    """A third of all rows hold one short text, another third one long text."""
    from pyspark.sql import functions as F

    text = F.when(F.col("id") % 3 == 0, F.lit("x")).when(F.col("id") % 3 == 1, F.repeat(F.lit("abc "), 100)).otherwise(
        F.concat(F.lit("own "), F.col("id").cast("string"), F.repeat(F.lit("z"), (F.col("id") % 50).cast("int"))))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = sharding.histogram_sort(docs, n_shards=5, rows_per_range=100).toPandas()
    sums = rows.groupby("shard")["size"].sum()
    assert (sums - sums.mean()).abs().max() <= 0.02 * sums.mean()
    for _, own in rows.sort_values("slot").groupby("shard"):
        assert own.slot.tolist() == list(range(len(own))) and own.key.is_monotonic_increasing


def test_odd_rows(odd_documents, no_documents):
    rows = sharding.histogram_sort(odd_documents).toPandas()
    assert len(rows) == 12 and rows[rows.doc_id == 3][["size", "text_crc32"]].values.tolist() == [[1, 0]]
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert sharding.histogram_sort(no_documents).count() == 0


def test_texts_are_written_by_shard_in_slot_order(odd_documents, tmp_path):
    """Whole rows move: the files hold every column, in slot order, in their shard's folder."""
    docs = odd_documents.selectExpr("*", "doc_id AS slot", "'x' AS shard", "lang AS `a.b`")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, n_shards=3)
    rows = sharding.read_shards(docs, path).selectExpr("*", "_metadata.file_path AS file").collect()
    assert sorted(map(repr, (tuple(r.doc) for r in rows))) == sorted(map(repr, map(tuple, docs.collect())))
    last = {}
    for r in rows:
        assert f"/shard={r.shard}/" in r.file and r.slot > last.get(r.file, -1)
        last[r.file] = r.slot
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
