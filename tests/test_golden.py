"""Hand-worked expected values (FIXTURES.md sections 3 and 4), plus the
DuckDB two-step oracle on the same rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

import oracle_sql
from storelift import Params, Sources, campaign_performance, in_store_activity
from storelift.operators.reservations import count_reservations
from tests.compare import compare
from tests.conftest import duck_from_sources
from tests.fixtures import golden_rows, repeat_rows

P = Params(batch_ts=dt.datetime(2024, 2, 1))
D = Decimal


@pytest.fixture(scope="module")
def golden(spark):
    return Sources.from_rows(spark, golden_rows())


@pytest.fixture(scope="module")
def repeats(spark):
    return Sources.from_rows(spark, repeat_rows())


@pytest.fixture(scope="module")
def golden_main(golden):
    return {(r.campaign_code, r.date_id.isoformat()): r.asDict() for r in campaign_performance(golden, P).collect()}


def test_reservation_counts(golden):
    got = {(r.campaign_code, r.partner, r.store_id, r.event_id): r.ttl_reservations
           for r in count_reservations(golden.campaign_reservation).collect()}
    assert got == {("C1", "A1", "S1", "E1"): 3, ("C1", "A1", "S3", "E1"): 1, ("C1", "A2", "S2", "E1"): 1,
                   ("C2", "A1", "S1", "E2"): 1, ("C9", "A1", "S1", "E9"): 1}


def test_main_rows(golden_main):
    assert set(golden_main) == {("C1", "2024-01-10"), ("C2", "2024-01-12")}


def _triple(row, fmt):
    return tuple(row[fmt.format(s)] for s in ("", "new_", "existing_"))


def test_main_participants(golden_main):
    r = golden_main[("C1", "2024-01-10")]
    assert (r["ttl_reservations"], r["ttl_reservation_participants"], r["ttl_walkin_participants"],
            r["ttl_participants"]) == (3, 2, 2, 4)
    assert (r["ttl_redeemed_recruitment_bags"], r["new_participants"], r["existing_participants"]) == (1, 1, 3)
    assert r["ttl_invitation"] == 0
    assert r["store_id_store_name"] == "S1 Store One"
    r2 = golden_main[("C2", "2024-01-12")]
    assert (r2["ttl_reservations"], r2["ttl_reservation_participants"], r2["ttl_walkin_participants"],
            r2["ttl_participants"]) == (1, 1, 0, 1)
    assert (r2["ttl_redeemed_recruitment_bags"], r2["new_participants"], r2["existing_participants"]) == (0, 0, 1)


def test_main_same_day(golden_main):
    r = golden_main[("C1", "2024-01-10")]
    assert _triple(r, "converted_{}member_0_days") == (2, 1, 1)
    assert r["CR_0_day"] == 0.5 and r["new_member_CR_0_day"] == 1.0
    assert r["existing_member_CR_0_day"] == pytest.approx(1 / 3)
    assert _triple(r, "converted_rrp_amt_{}0_days") == (D("180.00"), D("150.00"), D("30.00"))
    assert _triple(r, "converted_{}member_aspp_0_days") == (90.0, 150.0, 30.0)
    assert _triple(r, "converted_order_cnt_{}0_days") == (3, 1, 2)  # Q3: member 3 twice
    assert _triple(r, "converted_{}member_atv_0_days") == (60.0, 150.0, 15.0)
    assert (r["converted_initial_member_0_days"], r["converted_repurchase_member_0_days"]) == (1, 1)
    r2 = golden_main[("C2", "2024-01-12")]
    assert _triple(r2, "converted_{}member_0_days") == (0, 0, 0)
    assert (r2["CR_0_day"], r2["new_member_CR_0_day"], r2["existing_member_CR_0_day"]) == (0.0, None, 0.0)
    assert _triple(r2, "converted_rrp_amt_{}0_days") == (D("0.00"),) * 3
    assert _triple(r2, "converted_{}member_aspp_0_days") == (None,) * 3
    assert _triple(r2, "converted_{}member_atv_0_days") == (None,) * 3


def test_main_windows(golden_main):
    r = golden_main[("C1", "2024-01-10")]
    assert _triple(r, "converted_{}member_7_days") == (4, 1, 3)
    assert _triple(r, "converted_rrp_amt_{}7_days") == (D("420.00"), D("150.00"), D("270.00"))  # Q1
    assert _triple(r, "converted_order_cnt_{}7_days") == (6, 1, 5)
    assert (r["converted_initial_member_7_days"], r["converted_repurchase_member_7_days"]) == (2, 3)  # Q2
    assert _triple(r, "converted_{}member_30_days") == (4, 1, 3)
    assert _triple(r, "converted_rrp_amt_{}30_days") == (D("510.00"), D("150.00"), D("360.00"))
    assert _triple(r, "converted_order_cnt_{}30_days") == (9, 1, 8)
    assert (r["converted_initial_member_30_days"], r["converted_repurchase_member_30_days"]) == (2, 3)
    assert r["CR_7_days"] == 1.0
    r2 = golden_main[("C2", "2024-01-12")]
    for w in (7, 30):
        assert _triple(r2, "converted_{}member_%d_days" % w) == (1, 0, 1)
        assert _triple(r2, "converted_rrp_amt_{}%d_days" % w) == (D("0.00"),) * 3
        assert _triple(r2, "converted_order_cnt_{}%d_days" % w) == (1, 0, 1)
        assert (r2[f"converted_initial_member_{w}_days"], r2[f"converted_repurchase_member_{w}_days"]) == (0, 1)


def test_stamps(golden_main):
    r = golden_main[("C1", "2024-01-10")]
    assert r["dl_batch_date"] == "20240201"
    assert r["dl_load_time"] == dt.datetime(2024, 2, 1)


def test_sibling(golden):
    rows = in_store_activity(golden, P).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert (r["campaign_code"], r["store_id"], r["date_id"]) == ("C1", "S2", dt.date(2024, 1, 11))
    assert (r["ttl_reservations"], r["ttl_reservation_participants"], r["ttl_walkin_participants"],
            r["ttl_participants"], r["new_participants"], r["existing_participants"]) == (1, 1, 0, 1, 0, 1)


def _by_campaign(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.campaign_code, []).append(r.asDict())
    return out


@pytest.fixture(scope="module")
def repeat_main(repeats):
    return _by_campaign(campaign_performance(repeats, P))


def test_q4_both_sources(repeat_main):
    (r,) = repeat_main["K4"]
    assert (r["ttl_reservation_participants"], r["ttl_walkin_participants"], r["ttl_participants"]) == (1, 1, 1)
    assert r["converted_member_0_days"] == 1
    assert r["converted_rrp_amt_0_days"] == D("200.00") and r["converted_order_cnt_0_days"] == 2
    assert r["converted_rrp_amt_7_days"] == D("200.00") and r["converted_rrp_amt_30_days"] == D("200.00")


def test_q5_q7_agents(repeat_main):
    rows = repeat_main["K5"]
    assert len(rows) == 4
    for r in rows:
        assert (r["ttl_reservations"], r["ttl_participants"], r["converted_member_0_days"]) == (1, 1, 0)
        assert (r["converted_member_7_days"], r["converted_rrp_amt_7_days"], r["converted_order_cnt_7_days"]) == (
            2, D("100.00"), 2)
        assert r["CR_7_days"] == 2.0


def test_q6_days(repeat_main):
    rows = sorted(repeat_main["K6"], key=lambda r: r["date_id"])
    assert [r["date_id"] for r in rows] == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    assert [r["ttl_reservations"] for r in rows] == [2, 2]
    assert [r["ttl_participants"] for r in rows] == [1, 1]
    assert [r["converted_rrp_amt_0_days"] for r in rows] == [D("10.00"), D("20.00")]


def test_q7_campaign_types(repeat_main):
    rows = repeat_main["K7"]
    assert len(rows) == 8
    for r in rows:
        for w in (0, 7, 30):
            assert r[f"converted_rrp_amt_{w}_days"] == D("80.00")


def test_q9_null_event(repeat_main):
    (r,) = repeat_main["K9"]
    assert r["ttl_reservations"] is None
    assert r["converted_rrp_amt_0_days"] == D("30.00")
    for c, v in r.items():
        if "_7_days" in c or "_30_days" in c:
            assert v is None, c


def test_q10_id_variants(repeat_main):
    (r,) = repeat_main["K10"]
    assert r["converted_member_0_days"] == 1
    assert r["converted_rrp_amt_0_days"] == D("300.00") and r["converted_order_cnt_0_days"] == 2


def test_null_amount_and_zero_quantity(repeat_main):
    (r,) = repeat_main["K11"]
    assert (r["converted_member_0_days"], r["converted_order_cnt_0_days"]) == (1, 1)
    assert r["converted_rrp_amt_0_days"] is None and r["converted_member_aspp_0_days"] is None
    (r,) = repeat_main["K12"]
    assert (r["converted_member_0_days"], r["converted_order_cnt_0_days"]) == (1, 1)
    assert r["converted_rrp_amt_0_days"] == D("0.00")


@pytest.mark.parametrize("which", ["golden", "repeats"])
@pytest.mark.parametrize("name", ["campaign_performance", "in_store_activity"])
def test_against_oracle(spark, which, name):
    src = Sources.from_rows(spark, golden_rows() if which == "golden" else repeat_rows())
    fn = campaign_performance if name == "campaign_performance" else in_store_activity
    con = duck_from_sources(src)
    sql = oracle_sql.oracle_queries(with_roles=False)[name]
    assert compare(fn(src, P), con, sql) == []


def test_clean_mode_counts_each_member_once(golden):
    """parity=False: each member's window totals once per report row (no Q1
    doubling of amounts, no Q3 multiplication of orders)."""
    p = Params(batch_ts=dt.datetime(2024, 2, 1), parity=False)
    rows = {(r.campaign_code, r.date_id.isoformat()): r.asDict() for r in campaign_performance(golden, p).collect()}
    r = rows[("C1", "2024-01-10")]
    # Same day: member 1 (150, one order) and member 3 (30, one order).
    assert _triple(r, "converted_rrp_amt_{}0_days") == (D("180.00"), D("150.00"), D("30.00"))
    assert _triple(r, "converted_order_cnt_{}0_days") == (2, 1, 1)
    # 7 days: member 2 nets 100 once (not 200), member 4 adds day 7.
    assert _triple(r, "converted_rrp_amt_{}7_days") == (D("320.00"), D("150.00"), D("170.00"))
    assert _triple(r, "converted_order_cnt_{}7_days") == (5, 1, 4)
    # 30 days: member 3 adds day 20, member 4 day 30 (day 31 excluded).
    assert _triple(r, "converted_rrp_amt_{}30_days") == (D("410.00"), D("150.00"), D("260.00"))
    assert _triple(r, "converted_order_cnt_{}30_days") == (7, 1, 6)
    # Member counts do not depend on the mode.
    assert _triple(r, "converted_{}member_7_days") == (4, 1, 3)
