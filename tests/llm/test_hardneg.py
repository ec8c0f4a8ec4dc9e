from __future__ import annotations

import math

import numpy as np
import pytest

from storelift.llm import hardneg, queries

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, step=50, scale=256):
    """All scores in Python integers; rows (vec_id, label, vector) all take part and have ids of their own."""
    ids = [r[0] for r in rows]
    ints = np.array([[math.floor(scale * v) for v in r[2]] for r in rows], object)
    small = np.array(ints, np.int64)
    out = []
    for k, (i, label, _) in enumerate(rows):
        if i % step:
            continue
        score = (small @ small[k]).tolist()
        same = sorted((-score[j], ids[j]) for j in range(len(rows)) if j != k and rows[j][1] == label)[:5]
        for s, pos in same:
            p = -s
            others = sorted((-score[j], ids[j]) for j in range(len(rows)) if rows[j][1] != label and 50 * p <= 100 * score[j] <= 95 * p)
            out += [(i, pos, r, n, p, -t) for r, (t, n) in enumerate(others[:3], 1)]
    return sorted(out)


def result(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [float(v) for v in r.embedding]) for r in table]
    got = result(queries.op11_hard_negatives(spark, sf))
    assert got == brute(rows) and len(got) > 400


def test_oracle_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(queries.ORACLE_SQL["op11_hard_negatives"]).fetch_df()
    got = queries.op11_hard_negatives(spark, sf).toPandas()
    assert sorted(want.columns) == sorted(got.columns) and len(got) > 50
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want[got.columns].values.tolist()))


@pytest.mark.parametrize("dim, blocks", [(3, (50, 4)), (70, (8192, 2048)), (64, (100, 5))])
def test_clusters_ties_and_blocks(spark, dim, blocks):
    """Near copies across labels, a label with a third of all rows, one vector in many rows."""
    rng = np.random.default_rng(dim)
    n = 500
    x = rng.normal(size=(20, dim))[rng.integers(0, 20, n)] + 0.05 * rng.normal(size=(n, dim))
    x[::5] = x[0] * np.where(rng.random(n) < 0.5, 1.0, 0.9)[::5, None]
    x[7] = 0
    rows = [(int(i), 0 if i % 3 == 0 else int(i % 7), v.tolist()) for i, v in zip(rng.permutation(n), x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6).selectExpr("*", "1 AS key", "2 AS x", "3 AS rank", "4 AS dim", "5 AS codes")
    got = result(hardneg.mine(df, anchor_step=20, block_rows=blocks[0], block_anchors=blocks[1]))
    assert got == brute(rows, step=20) and got


def test_intervals_hold_and_filter():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(3000, 64)) / 8).astype(np.int64)
    codes, fit = hardneg.one_bit_codes(x)
    estimate, half = hardneg.Anchors(x[:40]).intervals(codes, fit)
    exact = x[:40] @ x.T
    assert (np.abs(estimate - exact) <= half).all()
    fifth = -np.sort(-exact, axis=1)[:, 5]
    assert (estimate + half >= fifth[:, None]).mean() < 0.1


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.6, 0.0]), (4, 2, [0.4, 0.0]),
            (5, 2, [-1.0, 0.0]), (50, 3, [-1.0, 0.0]), (51, 3, [1.0, 0.0]), (100, 9, [2.0, 2.0]), (6, None, [1.0, 0.0]), (7, 1, None),
            (8, 1, [nan, 0.0]), (9, 1, [inf, 0.0]), (10, 1, [None, 0.0]), (None, 1, [1.0, 0.0]), (11, 1, [1e300, 0.0]),
            (12, 1, [1.0]), (13, 1, []), (150, 1, []), (14, 2, [])]
    got = result(hardneg.mine(spark.createDataFrame(rows, SCHEMA)))
    p = 256 * 256
    assert got == [(0, 1, 1, 2, p, 256 * 230), (0, 1, 2, 3, p, 256 * 153), (150, 13, 1, 14, 0, 0)]
    assert hardneg.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    # One id, two vectors: two rows, each an anchor and a candidate.
    twice = result(hardneg.mine(spark.createDataFrame([(0, 1, [1.0]), (0, 1, [2.0]), (1, 2, [1.5])], SCHEMA)))
    assert twice == [(0, 0, 1, 1, 2 * p, 256 * 384)]
