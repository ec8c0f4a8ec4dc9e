from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from storelift.llm import queries, simhash

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """(doc_id, hex, component) sorted, by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(fps, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, f"{f:016x}", least[find(i)]) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op12_simhash_trie(spark, SF)) == brute(rows)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    clashing = odd_documents.selectExpr("*", "1L AS fp", "2 AS fingerprint", "3 AS unit", "4 AS component_id")
    assert result(simhash.near_duplicates(clashing)) == brute(rows)
    assert simhash.near_duplicates(no_documents).count() == 0


def clustered(rng, n):
    """Fingerprints around a few centers, chains and lone ones."""
    centers = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    near = []
    for c in centers:
        x = c
        for _ in range(n // 12):
            x = x ^ np.uint64(1 << int(rng.integers(64))) if rng.random() < 0.5 else c ^ np.uint64(1 << int(rng.integers(64)))
            near.append(x)
    far = rng.integers(0, 1 << 63, n // 2, dtype=np.uint64) << np.uint64(1)
    return np.unique(np.concatenate((np.array(near, np.uint64), far, np.array([0, 1, 7, (1 << 64) - 1], np.uint64))))


@pytest.mark.parametrize("budget", [0, 1, 3])
def test_trie_links_are_all_links(budget, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 500)
    x = clustered(np.random.default_rng(budget), 900)
    want = {(i, j) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= budget).tolist() if i < j}
    got = [p for i, j in simhash.trie_links(x, x, budget, True) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    a, b = x[::2], x[1::2]
    got = [p for i, j in simhash.trie_links(a, b, budget) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(b ^ a[i]) <= budget).tolist()}


@pytest.mark.parametrize("node_rows", [5, 40, 10_000])
def test_units_lose_no_component(spark, node_rows):
    """Node pairs of any size, also of a few fingerprints, and a crowded prefix."""
    x = clustered(np.random.default_rng(7), 600 if node_rows > 5 else 90)
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 3
    label = np.arange(len(x))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    edges = simhash.links(fps, 3, node_rows).collect()
    at = {int(v): i for i, v in enumerate(x.view(np.int64))}
    own = simhash._reduced(np.arange(len(x)), np.array([at[r.a] for r in edges]), np.array([at[r.b] for r in edges]))
    assert (own == label).all()


def test_spark_hash_is_the_same(spark):
    """Fingerprint of one shingle: its hash, which Spark's xxhash64 gives too."""
    text = "Ünï one TWO"
    want = spark.sql("SELECT lower(hex(xxhash64('Ünï one two')))").first()[0]
    assert f"{simhash.fingerprint_of(text):016x}" == want.rjust(16, "0")
