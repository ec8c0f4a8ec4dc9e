"""Randomised equivalence: the one-pass Spark plans against the two-step
DuckDB oracle on small random inputs that mix every repeat case (several
member rows, id text variants, both sources, several agents and campaign
types, NULL keys and amounts, returns, window edges, bucket edges)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

import oracle_sql
from storelift import Params, Sources, campaign_performance, in_store_activity
from tests.compare import compare
from tests.conftest import duck_from_sources
from tests.fixtures import FIRST, REPEAT, R, V, X


def random_rows(seed: int) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 9, 0)
    stores = ["S1", "S2", "S3", "S4"]
    members = [str(i) for i in range(1, 9)]

    def mid(m):  # member id text, sometimes a zero-padded variant
        return ("0" + m) if rnd.random() < 0.15 else m

    def when():
        return base + dt.timedelta(days=rnd.randint(0, 70), hours=rnd.randint(0, 10))

    phy = [("S1", "LCS East", "East", "P1"), ("S2", "LCS West", "West", "P2"), ("S3", "LBR", "North", "P3"),
           ("S4", "LBR", "South", "P4"), ("S2", "LCS West", "West2", "P2b")]
    app = [(1, "Shanghai", "One"), (2, "Beijing", "Two"), (3, "Wuhan", None), (2, None, "Two bis")]
    camps = [("C1", "LTP"), ("C2", "MBB"), ("C3", "LTP"), ("C3", "MBB")]
    mbr = []
    for m in members:
        for _ in range(rnd.choice([0, 1, 1, 2])):
            mbr.append((mid(m), when() if rnd.random() < 0.9 else None, rnd.choice(stores + [None])))
    cpn = [(mid(rnd.choice(members)), when(), rnd.choice(stores), rnd.choice(["Q240065", "Q240065", "X"]),
            rnd.choice(["redeemed", "redeemed", "void"])) for _ in range(12)]
    rev = []
    for _ in range(90):
        si = rnd.choice([0, 0, 1, 1, 2, 3])
        status = rnd.choice([V] * 8 + [X, R, None])
        rev.append((
            rnd.choice(["C1", "C1", "C2", "C3", "C9"]), None, rnd.choice(["A1", "A2", "A2", None]), stores[si],
            rnd.choice([si + 1, si + 1, 9]), rnd.choice(["E1", "E2", "E2", None]) if rnd.random() < 0.1
            else rnd.choice(["E1", "E2"]),
            mid(rnd.choice(members)) if rnd.random() < 0.95 else None,
            status, rnd.choice([1, 1, 2]), when() if rnd.random() < 0.95 else None,
        ))
    rev = [(r[0], f"Camp {r[0]}" if rnd.random() < 0.9 else "Alt", *r[2:]) for r in rev]

    def order_row(member, date, store):
        amt = Decimal(rnd.randint(-200, 900)) / 4
        return (
            member, date, store,
            rnd.choice([f"O{rnd.randint(1, 30)}", None]) if rnd.random() < 0.1 else f"O{rnd.randint(1, 30)}",
            rnd.choice([True] * 6 + [False, None]),
            rnd.choice([1] * 8 + [0]),
            rnd.choice(["LCS"] * 6 + ["LBR", None]),
            rnd.choice([FIRST, REPEAT, REPEAT, None]),
            rnd.choice([1, 1, 2, -1, 0]),
            None if rnd.random() < 0.05 else amt.quantize(Decimal("0.01")),
        )

    orders = []
    for _ in range(25):  # background purchases
        orders.append(order_row(mid(rnd.choice(members)) if rnd.random() < 0.95 else None,
                                (base + dt.timedelta(days=rnd.randint(0, 110))).date(), rnd.choice(stores)))
    for r in rev:  # purchases around the visits: window edges and beyond
        if r[6] is None or r[9] is None or rnd.random() < 0.3:
            continue
        member = r[6].lstrip("0") or r[6]
        for off in rnd.sample([-1, 0, 0, 1, 3, 7, 8, 20, 29, 30, 31, 45], rnd.randint(1, 3)):
            store = r[3] if rnd.random() < 0.85 else rnd.choice(stores)
            orders.append(order_row(mid(member), r[9].date() + dt.timedelta(days=off), store))
        if rnd.random() < 0.3:  # joined at this store on the visit day: a new member
            jt = r[9] - dt.timedelta(hours=rnd.choice([1, 30]))
            mbr.append((mid(member), jt, r[3]))
            if rnd.random() < 0.4:  # same join time, another (or no) store: both tags
                mbr.append((mid(member), jt, rnd.choice([s for s in stores if s != r[3]] + [None])))
        if rnd.random() < 0.3:
            cpn.append((mid(member), r[9] + dt.timedelta(hours=2), r[3], "Q240065", "redeemed"))
    return {"phy_store": phy, "app_store": app, "campaign_code": camps, "member_detail": mbr,
            "coupon_benefit": cpn, "campaign_reservation": rev, "member_order_detail": orders}


@pytest.mark.parametrize("seed,bucket", [(1, 120), (2, 30), (3, 31), (4, 45), (5, 365), (6, 120), (7, 60),
                                         (8, 30), (9, 120), (10, 90)])
def test_one_pass_equals_two_step(spark, seed, bucket):
    src = Sources.from_rows(spark, random_rows(seed))
    con = duck_from_sources(src)
    oq = oracle_sql.oracle_queries(with_roles=False)
    p = Params(batch_ts=dt.datetime(2024, 2, 1), bucket_days=bucket)
    assert compare(campaign_performance(src, p), con, oq["campaign_performance"]) == []
    assert compare(in_store_activity(src, p), con, oq["in_store_activity"]) == []


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_timestamp_order_days(spark, seed):
    """date_id given as a timestamp with a time of day: the source groups the
    order roll-ups by the raw value and joins them by day, so one member-day
    can contribute several roll-up rows."""
    from pyspark.sql import functions as F

    rows = random_rows(seed)
    rnd = random.Random(seed)
    rows["member_order_detail"] = [
        (r[0], dt.datetime.combine(r[1], dt.time(rnd.choice([0, 9, 18]))), *r[2:]) for r in rows["member_order_detail"]
    ]
    base = Sources.from_rows(spark, {k: v for k, v in rows.items() if k != "member_order_detail"})
    orders = spark.createDataFrame(
        rows["member_order_detail"],
        "crm_member_id string, date_id timestamp_ntz, lego_store_code string, original_order_id string, "
        "if_eff_order_tag boolean, is_rrp_sales_type int, distributor_name string, "
        "initial_vs_repurchase_lifecycle string, sales_qty int, order_rrp_amt decimal(18,2)")
    src = Sources(**{**{n: getattr(base, n) for n in ("campaign_reservation", "phy_store", "app_store",
                                                    "member_detail", "campaign_code", "coupon_benefit")},
                     "member_order_detail": orders})
    con = duck_from_sources(src)
    oq = oracle_sql.oracle_queries(with_roles=False)
    p = Params(batch_ts=dt.datetime(2024, 2, 1))
    assert compare(campaign_performance(src, p), con, oq["campaign_performance"]) == []
    assert orders.select(F.to_date("date_id")).distinct().count() < orders.select("date_id").distinct().count()
