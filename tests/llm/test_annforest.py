from __future__ import annotations

import numpy as np

from storelift.llm import annforest, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, query_step=50, k=5):
    x = x.astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % query_step == 0):
        s = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -s.round(12))) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return np.mean([len({v for v, _ in w} & got.get(q, set())) / max(1, len(w)) for q, w in want.items()])


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op2_nearest_vectors(spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    want = brute(table.vec_id.to_numpy(), np.stack(list(table.embedding)))
    assert recall(rows, want) >= 0.9 and len(rows) == 5 * len(want)
    exact = {(q, v): s for q, w in brute(table.vec_id.to_numpy(), np.stack(list(table.embedding)), k=len(table)).items() for v, s in w}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-12 for r in rows)
    for q in want:
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))


def test_clusters_with_few_matches(spark):
    """Structured vectors: a fixed number of matches, buckets and salts suffice."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(60, 16))
    x = (np.repeat(centers, 50, axis=0) + 0.15 * rng.normal(size=(3000, 16))).astype(np.float32)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    old, annforest.BUCKET_ROWS = annforest.BUCKET_ROWS, 100
    try:
        rows = annforest.nearest(docs, trees=8, min_matches=400, match_share=0.0).collect()
    finally:
        annforest.BUCKET_ROWS = old
    assert recall(rows, brute(np.arange(3000), x)) >= 0.9


def test_hot_vector_ties_and_exclusions(spark):
    """A third of all rows hold one vector; ties go to the smaller id."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {}
    for r in annforest.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert [v for _, v in sorted(got[150])] == [0, 3, 6, 9, 12]
    assert [v for _, v in sorted(got[0])] == [3, 6, 9, 12, 15]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (50, [3e38, 3e38]), (100, [-1.0, 0.0])]
    got = annforest.nearest(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "2 AS score")).collect()
    lists = {}
    for r in got:
        lists.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert sorted(lists) == [0, 50, 100]
    assert sorted(lists[0]) == [(1, 1, 1.0), (2, 50, 0.707106781), (3, 2, 0.0), (4, 100, -1.0)]
    assert annforest.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cluster_of_near_copies(spark):
    """Different vectors whose cosines single precision cannot tell apart."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=64) + 1e-4 * rng.normal(size=(3000, 64))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in annforest.nearest(docs, query_step=500, trees=4, min_matches=12_000, match_share=0.0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 3000, 500):
        gap = ((unit - unit[q]) ** 2).sum(axis=1)
        assert [v for _, v in sorted(found[q])] == [v for v in np.argsort(gap, kind="stable") if v != q][:5]


def test_many_classes_at_one_cosine(spark):
    """Rescaled vectors are classes of their own; the smaller ids win all cuts."""
    rng = np.random.default_rng(9)
    ids = rng.permutation(400)
    x = [(np.array([1.0, -1.0, 1.0, 1.0]) * (i + 1)).tolist() for i in range(400)]
    rows = [(int(i), v) for i, v in zip(ids, x)] + [(1000 + i, rng.normal(size=4).tolist()) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = {}
    for r in annforest.nearest(docs, query_step=100).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in (0, 100, 200, 300):
        assert [v for _, v in sorted(found[q])] == [v for v in range(7) if v != q][:5]
