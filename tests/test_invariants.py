
from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod


@pytest.fixture(scope="module")
def rows(spark):
    return [r.asDict() for r in entry_mod.queries()["campaign_performance"](spark, "/root/testdata/sf0.01").collect()]


def test_participant_counts_bounded(rows):
    for r in rows:
        for c in ("ttl_reservation_participants", "ttl_walkin_participants", "ttl_redeemed_recruitment_bags",
                  "new_participants", "existing_participants"):
            assert r[c] <= r["ttl_participants"], c


def test_windows_nest(rows):
    # A code listed with two campaign types meets the 7- and 30-day rows of
    # both, with the same members; a NULL event meets none.
    for r in rows:
        if r["converted_member_7_days"] is None:
            assert r["converted_member_30_days"] is None and r["CR_7_days"] is None
            continue
        assert r["converted_member_0_days"] <= r["converted_member_7_days"] <= r["converted_member_30_days"]
        for w in (0, 7, 30):
            assert r[f"converted_initial_member_{w}_days"] + r[f"converted_repurchase_member_{w}_days"] >= \
                r[f"converted_member_{w}_days"]
    assert any(r["converted_member_7_days"] is None for r in rows)


def test_same_day_rates_are_fractions(rows):
    for r in rows:
        for c in ("CR_0_day", "new_member_CR_0_day", "existing_member_CR_0_day"):
            assert r[c] is None or 0.0 <= r[c] <= 1.0, c


def test_segments_add_up(rows):
    for r in rows:
        for w in (0, 7, 30):
            for kind in ("order_cnt", "rrp_amt"):
                total, new, old = (r[f"converted_{kind}_{seg}{w}_days"] for seg in ("", "new_", "existing_"))
                if None not in (total, new, old):
                    assert new + old == total


def test_fanout_seen(rows):
    # Several agents per campaign, store and event repeat report rows (Q5).
    keys = [(r["campaign_code"], r["store_id"], r["date_id"], r["agent_id"]) for r in rows]
    assert len(keys) > len(set(keys))
    # A campaign code listed with two types repeats the window rows (Q7).
    assert len(rows) > len(set(keys))


def test_joins_also_miss(rows):
    assert any(r["ttl_reservations"] is None for r in rows)
    assert any(r["store_name"] is None for r in rows)
