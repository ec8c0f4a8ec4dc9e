"""The bucketed range join against brute force on random inputs."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from storelift.operators.attribution import window_join


def _brute(left, right, max_days):
    out = set()
    for k, d, lid in left:
        for k2, d2, rid in right:
            if k is None or k2 is None or d is None or d2 is None or k != k2:
                continue
            dd = (d2 - d).days
            if 0 <= dd <= max_days:
                out.add((lid, rid, dd))
    return out


@pytest.mark.parametrize("seed,max_days,bucket", [
    (1, 30, 30), (2, 30, 31), (3, 30, 120), (4, 7, 7), (5, 0, 1), (6, 0, 5), (7, 30, 45), (8, 13, 200),
])
def test_window_join_matches_brute_force(spark, seed, max_days, bucket):
    rnd = random.Random(seed)
    base = dt.date(1969, 11, 1)  # crosses the epoch: negative day numbers too

    def day():
        return None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 240))

    left = [(rnd.choice(["a", "b", "c", None]), day(), i) for i in range(150)]
    right = [(rnd.choice(["a", "b", "c", None]), day(), j) for j in range(400)]
    ldf = spark.createDataFrame(left, "k string, ld date, lid int")
    rdf = spark.createDataFrame(right, "k string, rd date, rid int")
    got = {(r.lid, r.rid, r.dd) for r in
           window_join(ldf, rdf, ["k"], "ld", "rd", max_days, bucket).select("lid", "rid", "dd").collect()}
    assert got == _brute(left, right, max_days)


def test_window_join_rejects_narrow_buckets(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "k string, d date")
    with pytest.raises(ValueError):
        window_join(df, df, ["k"], "d", "d", 30, 29)
