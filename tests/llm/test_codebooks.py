from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from storelift.llm import codebooks, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The contract row by row, in Python integers; rows (vec_id, vector, label) are all usable."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    p = len(rows[0][1]) // parts
    ints = [[[math.floor(scale * v) for v in x[k * p : (k + 1) * p]] for k in range(parts)] for _, x, _ in rows]
    x = np.array(ints, np.int64)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = np.stack([((x[:, k, None] - books[k][None]) ** 2).sum(-1) for k in range(parts)], 1)
        return d.argmin(-1), d.min(-1)

    for _ in range(rounds):
        code, _ = assign()
        for k in range(parts):
            for e in range(books.shape[1]):
                own = x[code[:, k] == e, k]
                if len(own):
                    books[k, e] = [sum(c) // len(own) for c in own.T.tolist()]
    code, d = assign()
    error = d.sum(1).tolist()
    sums = {}
    for (_, _, label), e in zip(rows, error):
        sums[label] = sums.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in cs), e, sums[label], sha) for (i, _, label), cs, e in zip(rows, code.tolist(), error)), key=str)


def result(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, [float(v) for v in r.embedding], r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(queries.op13_laesa_codes(spark, sf)) == brute(rows)


def clusters(rng, n, dim, hot=True):
    x = rng.normal(size=(max(2, n // 40), dim))[rng.integers(0, max(2, n // 40), n)] + 0.05 * rng.normal(size=(n, dim))
    if hot:
        x[::3] = x[0]
    return [(int(i), v.tolist(), None if i % 9 == 4 else int(i % 3)) for i, v in zip(rng.permutation(n), x)]


@pytest.mark.parametrize("n, entries", [(700, 40), (30, 256), (1, 256)])
def test_clusters_hot_vector_and_few_rows(spark, n, entries):
    rows = clusters(np.random.default_rng(n), n, 12)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS code", "2 AS error", "3 AS x", "4 AS pivots")
    assert result(codebooks.encode(df, entries=entries)) == brute(rows, entries=entries)


def test_pruning_saves_evaluations_and_keeps_ties():
    rng = np.random.default_rng(3)
    entries = rng.integers(-5, 5, (256, 4)) * 100
    entries[200:] = entries[:56]
    x = entries[rng.integers(0, 256, 3000)] + rng.integers(-3, 4, (3000, 4))
    coder = codebooks.Coder(entries[None].astype(np.int64))
    to = coder.distances(x[:, None])
    index, best, evaluated = codebooks.nearest_entries(x, to, entries, coder.of_entries[0])
    d = ((x[:, None] - entries[None]) ** 2).sum(-1)
    assert (index == d.argmin(1)).all() and (best == d.min(1)).all() and evaluated < 0.2 * d.size


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25, 1.0, 2.0], 1), (1, [0.5, -0.25, 1.0, 2.0], 1), (2, [0.1, 0.0, -0.0001, 3.0], None), (None, [9.0, 9.0, 9.0, 9.0], 1), (7, [0.0] * 4, 2)]
    odd = [(3, None, 1), (4, [nan, 1.0, 1.0, 1.0], 1), (5, [inf, 1.0, 1.0, 1.0], 1), (6, [None, 1.0, 1.0, 1.0], 1)]
    apart = [(8, [1.0, 2.0], 2), (9, [], None), (10, [1e300, 0.0, 0.0, 0.0], 3)]
    got = result(codebooks.encode(spark.createDataFrame(good + odd + apart, SCHEMA)))
    want = brute(good)
    sha, sums = want[0][4], {1: 0, 2: 0, None: 0}
    for label in sums:
        sums[label] = next(w[3] for w, r in ((w, r) for w in want for r in good if r[0] == w[0]) if r[2] == label)
    more = [(8, None, None, sums[2], sha), (9, None, None, sums[None], sha), (10, None, None, None, sha)]
    assert got == sorted(want + more, key=str)
    assert codebooks.encode(spark.createDataFrame([], SCHEMA)).count() == 0
    uneven = result(codebooks.encode(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1), (2, [2.0, 2.0, 3.0], 1)], SCHEMA)))
    assert uneven == brute([(1, [1.0, 2.0, 3.0, 0.0], 1), (2, [2.0, 2.0, 3.0, 0.0], 1)])
