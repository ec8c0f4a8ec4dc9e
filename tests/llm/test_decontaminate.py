from __future__ import annotations

import re
from collections import Counter

import numpy as np

from storelift.llm import decontaminate as D
from storelift.llm import queries
from storelift.llm.words import word_hashes

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def containment(text, item):
    w, v = WORD.findall((text or "").lower()), WORD.findall(item.lower())
    held = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    covered = set()
    for k in range(len(v) - 4):
        if tuple(v[k : k + 5]) in held:
            covered |= set(range(k, k + 5))
    return len(covered) / len(v)


def test_whole_table(spark):
    rows = queries.op9_decontamination(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if containment(d.text, i.text) >= D.OVERLAP}
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(want) > 0
    assert len(rows) == len(want)


def test_wand_finds_all_above_the_threshold(spark):
    """Block-max WAND against scoring every item for every passage."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    (index,) = D.indexes(items)
    D.POSTINGS_PER_BLOCK, before = 3, D.POSTINGS_PER_BLOCK
    index.__post_init__()
    D.POSTINGS_PER_BLOCK = before
    rng = np.random.default_rng(0)
    texts = [r.text for r in items.collect()]
    for _ in range(60):
        mix = " ".join(texts[i][: int(rng.integers(20, 300))] for i in rng.integers(0, len(texts), 3))
        query = np.unique(word_hashes([mix.encode()])[0])
        score = np.zeros(len(index.item_ids))
        at = np.flatnonzero(np.isin(index.words, query))
        for w in at:
            score[index.items[index.first[w] : index.first[w + 1]]] += index.impact[index.first[w] : index.first[w + 1]]
        for threshold in (0.2, 0.5, 0.9):
            want = {int(i): score[i] for i in np.flatnonzero(score >= threshold)}
            got = dict(index.search(query, threshold))
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_planted_and_clean(spark):
    question, answer = "which river runs through the old harbour town of the north", "the long grey river runs there."
    item = f"{question}?\n{answer}"
    rnd = np.random.default_rng(3)
    noise = lambda n: " ".join(f"x{i}" for i in rnd.integers(0, 10_000, n))
    words = item.split()
    edited = " ".join([*words[:7], "changed", *words[8:]])
    rows = [(1, noise(500) + " " + item.upper().replace("\n", " ") + " " + noise(300)), (2, noise(50) + "\n" + edited + " " + noise(90)),
            (3, noise(200) + " " + question + " " + noise(40)), (4, noise(100) + " " + answer), (5, " ".join(words[3:9]) + noise(60)),
            (6, item), (7, None), (8, ""), (9, noise(30_000) + " " + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, None), (12, " "), (13, noise(30) + ". " + noise(8)), (14, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaked_items(docs, items).collect()}
    assert got == {(1, 10), (2, 10), (6, 10), (9, 10)}
    clean = D.clean_documents(docs.withColumnRenamed("text", "text").selectExpr("*", "1 AS score", "2 AS item_id"), items)
    assert clean.columns == ["doc_id", "text", "score", "item_id"]
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 7, 8]


def test_several_index_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEMS_PER_INDEX", 15)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert len(D.indexes(items.select("item_id", "text"))) > 1
    split = {tuple(r) for r in D.leaked_items(docs, items).collect()}
    monkeypatch.undo()
    assert split == {tuple(r) for r in D.leaked_items(docs, items).collect()}


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank today."), (1, "one two")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in D.leaked_items(odd_documents, items).collect())
    assert got[(1, 1)] == 1 and got[(2, 1)] == 2 and got[(6, 1)] == 1 and got[(7, 1)] == 1 and got[(8, 1)] == 0
    assert D.leaked_items(no_documents, items).count() == 0
    assert D.leaked_items(odd_documents, items.where("false")).count() == 0
    assert D.clean_documents(odd_documents, items.where("false")).count() == 12
