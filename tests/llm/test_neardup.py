from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from storelift.llm import neardup, queries
from storelift.llm.components import components

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    inverted, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in inverted[x])
        for x in s:
            inverted[x].append(i)
        for j, k in shared.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                lo, hi = sorted((a, b), key=lambda r: rows[r][0])
                parent[hi] = lo
    return {d: (len(s), rows[find(i)][0]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_near_duplicates(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("seed, block", [(1, 2048), (2, 40)])
def test_group_of_edited_copies(spark, monkeypatch, seed, block):
    """Copies of one text with 0 to 9 changed words, most not similar to each
    other: links and components as by brute force, also with small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(10)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.choice([0, 1, 1, 2])] = [f"n{rnd.randrange(60)}"]
        rows.append((i * 3, " ".join(words[: rnd.choice([120, 120, 95])])))
    rows += [(i * 3 + 1, " ".join(f"u{rnd.randrange(9999)}" for _ in range(60)) + " " + " ".join(base[:30])) for i in range(60)]
    check(spark, rows)


def test_chain(spark):
    """Each text is similar to the next one only."""
    words = [f"c{i}" for i in range(400)]
    check(spark, [(100 - i, " ".join(words[i * 12 : i * 12 + 120])) for i in range(22)])


def test_odd_rows(spark, odd_documents, no_documents):
    got = {r.doc_id: r for r in neardup.near_duplicates(odd_documents).collect()}
    assert [got[d].n_shingles for d in (3, 4, 5, 6, 7)] == [0, 0, 0, 1, 1]
    assert [got[d].component_id for d in (1, 2, 3, 4, 5, 6, 7)] == [1, 1, 3, 4, 5, 6, 6]
    assert got[None].kept and got[None].component_id is None and got[None].n_shingles == 3
    copy = odd_documents.where("doc_id = 1").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    named = [r for r in neardup.near_duplicates(odd_documents.unionAll(copy)).collect() if r.doc_id is None]
    assert sorted((r.component_id, r.kept) for r in named if not r.kept) == [(1, False)] and len(named) == 2
    assert neardup.near_duplicates(no_documents).count() == 0
    from pyspark.sql import functions as F

    wide = odd_documents.withColumns({c: F.lit(1) for c in ("n", "rep", "signature", "component_id", "kept", "id")})
    kept = neardup.unique_documents(wide)
    assert kept.columns == wide.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "8", "9", "10", "None"])


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(300, 299), (305, 299)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and {got[i] for i in (299, 300, 305)} == {299}
