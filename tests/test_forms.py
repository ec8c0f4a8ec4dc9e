"""The other forms of an operator (sorted sweep, member bitmaps) give the same results."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import oracle_sql
from storelift import Params, Sources, campaign_performance, in_store_activity
from storelift.operators.attribution import visit_window_stats
from storelift.operators.bitmaps import coarser, counted, member_bitmaps
from storelift.operators.participations import participation_rows
from storelift.operators.metrics import BASE_KEYS, participation_metrics
from storelift.operators.reservations import RESERVATION_KEYS, count_reservations
from storelift.operators.sweep import visit_window_sweep
from storelift.plans.queries import PARAMS
from storelift.plans.reports import prepare, visitors_orders
from storelift.operators.rollups import daily_activity
from storelift.sources import testdata
from tests.compare import compare
from tests.conftest import duck_from_sources
from tests.test_random import random_rows

SF = "/root/testdata/sf0.01"
STATS = [f"{s}_{w}" for w in (0, 7, 30) for s in ("n", "amt", "ord", "hi", "lo")]


def rows_of(df):
    return sorted(str([None if v is None else (Decimal(v).normalize() if isinstance(v, Decimal) else v) for v in r])
                  for r in df.select("member_key", "store_id", "event_dt", *STATS).collect())


@pytest.mark.parametrize("seed", [31, 32, 33, 34])
def test_sweep_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = dt.date(1969, 12, 1)  # crosses the epoch
    day = lambda: None if rnd.random() < 0.03 else base + dt.timedelta(days=rnd.randint(0, 90))
    visits = sorted({(rnd.randint(1, 4), rnd.choice("AB"), base + dt.timedelta(days=rnd.randint(0, 90))) for _ in range(60)})
    daily = []
    for _ in range(250):
        m, eff = rnd.choice([1, 2, 3, 9, None]), rnd.random() < 0.7
        text = None if m is None else rnd.choice([str(m), f"0{m}", f"00{m}"])
        daily.append((m, rnd.choice(["A", "B", None]), day(), text, rnd.choice([None, Decimal("5.25"), Decimal("-1.50")]), eff,
                      rnd.randint(1, 3) if eff else 0, rnd.choice([0, 1]) if eff else None))
    vdf = spark.createDataFrame(visits, "member_key long, store_id string, event_dt date")
    ddf = spark.createDataFrame(daily, "member_key long, lego_store_code string, order_day date, crm_member_id string, "
                                       "order_rrp_amt decimal(18,2), has_eff_order boolean, trans_cnt long, initial_purchase int")
    want = []
    for m, s, d in visits:
        row, met = [m, s, d], False
        for w in (0, 7, 30):
            own = [r for r in daily if r[0] == m and r[1] == s and r[2] is not None and 0 <= (r[2] - d).days <= w]
            eff = [r for r in own if r[5]]
            amounts, flags = [r[4] for r in own if r[4] is not None], [r[7] for r in eff]
            row += [len({(r[3], r[7]) for r in eff}), sum(amounts).normalize() if amounts else None, sum(r[6] for r in eff) if eff else None,
                    max(flags, default=None), min(flags, default=None)]
            met = met or bool(own)
        if met:
            want.append(str(row))
    assert rows_of(visit_window_sweep(vdf, ddf)) == sorted(want)
    assert rows_of(visit_window_stats(vdf, ddf)) == sorted(want)


def test_sweep_equals_join_on_the_tables(spark):
    prepared = prepare(testdata.sources(spark, SF), PARAMS)
    daily = daily_activity(visitors_orders(prepared, PARAMS), PARAMS)
    got = rows_of(visit_window_sweep(prepared.visits, daily, PARAMS))
    assert got == rows_of(visit_window_stats(prepared.visits, daily, PARAMS)) and len(got) > 100


@pytest.mark.parametrize("seed", [41, 42, 43])
def test_reports_of_the_other_forms(spark, seed):
    src = Sources.from_rows(spark, random_rows(seed))
    con = duck_from_sources(src)
    oq = oracle_sql.oracle_queries(with_roles=False)
    p = Params(batch_ts=dt.datetime(2024, 2, 1), attribution="sweep", distinct="bitmap")
    assert compare(campaign_performance(src, p), con, oq["campaign_performance"]) == []
    assert compare(in_store_activity(src, p), con, oq["in_store_activity"]) == []


def test_bitmap_counts_on_the_tables(spark):
    """Also with padded ids and NULLs; and far fewer rows where members are many."""
    src = testdata.sources(spark, SF)
    bitmaps = dataclasses.replace(PARAMS, distinct="bitmap")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(count_reservations(src.campaign_reservation, bitmaps)) == key(count_reservations(src.campaign_reservation, PARAMS))
    rows = participation_rows(src, PARAMS, "main")
    for coupon in (True, False):
        assert key(participation_metrics(rows, BASE_KEYS, coupon, bitmaps)) == key(participation_metrics(rows, BASE_KEYS, coupon, PARAMS))
    # At the grain of a campaign type, one bitmap stands for hundreds of members.
    fine = member_bitmaps(rows, ["campaign_type", "store_id"], "member_id", {"members": "true"})
    coarse = coarser(fine, ["campaign_type"], ["members"])
    want = {r[0]: r[1] for r in rows.groupBy("campaign_type").agg(F.count_distinct("member_id")).collect()}
    assert {r[0]: r[1] for r in counted(coarse, ["campaign_type"], ["members"]).collect()} == want
    assert coarse.count() * 20 < sum(want.values())


def test_bitmap_classes(spark):
    """Texts of one number are members of their own; odd texts, long numbers and NULL too."""
    texts = ["7", "07", "007", "7", " 7", "+7", "-7", "x", "", "0", "00", None, None, "32767", "32768", "123456789012345678", "1234567890123456789",
             "99999999999999999999", "0000000000000000000007", "٧"]
    df = spark.createDataFrame([("k", t) for t in texts] + [("empty", None)], "k string, t string")
    got = {r.k: r.n for r in counted(member_bitmaps(df, ["k"], "t", {"n": "true"}), ["k"], ["n"]).collect()}
    assert got == {"k": len({t for t in texts if t is not None}), "empty": 0}


def test_reservation_keys_without_members_stay(spark):
    rows = [("C", "n", "A", "S", 1, "E", None, "live", 1, None), ("C", "n", "A", "S", 1, "F", "5", "live", 1, None)]
    src = Sources.from_rows(spark, {"campaign_reservation": rows})
    for form in ("rows", "bitmap"):
        got = {r.event_id: r.ttl_reservations for r in count_reservations(src.campaign_reservation, Params(distinct=form)).collect()}
        assert got == {"E": 0, "F": 1}, form
    assert count_reservations(src.campaign_reservation, Params(distinct="bitmap")).columns == [*RESERVATION_KEYS, "ttl_reservations"]


def test_unknown_forms_are_refused():
    for bad in ({"attribution": "other"}, {"distinct": "sketch"}):
        with pytest.raises(ValueError):
            Params(**bad)
