"""A member holding a third of all reservation rows: results stay right and
the member-keyed join is split by AQE instead of landing in one task."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

import oracle_sql
from storelift import Params, Sources, in_store_activity, participations
from tests.compare import compare
from tests.conftest import duck_from_sources
from tests.fixtures import V


def skewed_rows(n: int = 6000, seed: int = 7) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    base = dt.datetime(2024, 3, 1, 10)
    rev = []
    for i in range(n):
        member = "1" if i % 3 == 0 else str(2 + rnd.randint(0, 2000))  # member 1: a third of all rows
        rev.append(("C1", "Camp", f"A{rnd.randint(0, 3)}", "S1", 1, f"E{rnd.randint(0, 40)}", member, V,
                    rnd.choice([1, 2]), base + dt.timedelta(days=rnd.randint(0, 60), minutes=i)))
    members = [(str(m), base - dt.timedelta(days=m % 90), "S1") for m in range(1, 2003)]
    return {
        "phy_store": [("S1", "LCS East", "East", "P1"), ("S9", "LBR", "North", "P9")],
        "app_store": [(1, "Shanghai", "One")],
        "campaign_code": [("C1", "LTP")],
        "member_detail": members,
        "coupon_benefit": [],
        "campaign_reservation": rev,
        "member_order_detail": [],
    }


@pytest.fixture
def skew_session(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_member_join_is_split(skew_session):
    spark = skew_session
    src = Sources.from_rows(spark, skewed_rows())
    p = Params(batch_ts=dt.datetime(2024, 4, 1), broadcast_max_bytes=0)
    df = participations(src, p, "main")
    rows = df.collect()
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin(skew=true) [member_key], [_mbr_key], LeftOuter" in plan, \
        "AQE did not split the hot member's join partition"
    con = duck_from_sources(src)
    oq = oracle_sql.oracle_queries(with_roles=False)
    assert compare(df, con, oq["participations_main"]) == []
    assert len(rows) > 0


def test_hot_member_report_right(skew_session):
    spark = skew_session
    src = Sources.from_rows(spark, skewed_rows(3000, 11))
    p = Params(batch_ts=dt.datetime(2024, 4, 1), broadcast_max_bytes=0)
    con = duck_from_sources(src)
    oq = oracle_sql.oracle_queries(with_roles=False)
    assert compare(in_store_activity(src, p), con, oq["in_store_activity"]) == []


def test_placeholder_member_and_many_bad_ids(skew_session):
    """A placeholder member registered at many stores, and a third of all
    visits with malformed ids: nothing is collected into a set, the bad ids
    spread over the join's partitions, results match."""
    from pyspark.sql import functions as F

    from storelift.operators.participations import participation_rows

    spark = skew_session
    rows = skewed_rows(1500, 3)
    when = dt.datetime(2024, 3, 1, 9)
    rows["member_detail"] = rows["member_detail"] + [("1", when, f"S{i}") for i in range(500)]
    rows["campaign_reservation"] = [(*r[:6], f"bad{i}" if i % 3 == 1 else r[6], *r[7:]) for i, r in enumerate(rows["campaign_reservation"])]
    p = Params(batch_ts=dt.datetime(2024, 4, 1), broadcast_max_bytes=0, on_bad_id="null")
    src = Sources.from_rows(spark, rows)
    out = participation_rows(src, p, "main")
    got = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan
    bad = [r for r in got if r.member_id.startswith("bad")]
    assert len(bad) == 500 and len({r.member_key for r in bad}) == 500 and all(r.join_time is None for r in bad)
    good = Sources.from_rows(spark, rows | {"campaign_reservation": [r for r in rows["campaign_reservation"] if not r[6].startswith("bad")]})
    con = duck_from_sources(good)
    oq = oracle_sql.oracle_queries(with_roles=False)
    assert compare(participations(good, p, "main"), con, oq["participations_main"]) == []
    assert len([r for r in got if not r.member_id.startswith("bad")]) == participations(good, p, "main").agg(F.count("*")).first()[0]
