"""Hand-written input rows (FIXTURES.md sections 3 and 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

V, X, R = "已核销", "已取消", "已预约"
FIRST, REPEAT = "会员生命周期首单", "repurchase"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _rev(code, agent, store, store_id, event, member, status, source, vt, name=None):
    names = {"C1": "Camp One", "C2": "Camp Two", "C9": "Camp Nine"}
    return (code, name or names.get(code, code), agent, store, store_id, event, member, status, source,
            ts(vt) if vt else None)


def _order(member, date, store, order, eff, rrp, dist, first, qty, amount):
    return (member, day(date), store, order, eff, rrp, dist, FIRST if first else REPEAT, qty,
            None if amount is None else Decimal(str(amount)).quantize(Decimal("0.01")))


def golden_rows() -> dict[str, list[tuple]]:
    """FIXTURES.md section 3."""
    return {
        "phy_store": [("S1", "LCS East", "East", "P1"), ("S2", "LBR", "North", "P2"), ("S3", "OTHER", "West", "P3")],
        "app_store": [(101, "Shanghai", "Store One"), (102, "Beijing", "Store Two")],
        "campaign_code": [("C1", "LTP"), ("C2", "MBB")],
        "member_detail": [
            ("1", ts("2024-01-10 10:00"), "S1"), ("2", ts("2023-05-01 00:00"), "S1"),
            ("3", ts("2023-06-01 00:00"), "S1"), ("3", ts("2023-07-01 00:00"), "S1"),
        ],
        "coupon_benefit": [
            ("1", ts("2024-01-10 18:00"), "S1", "Q240065", "redeemed"),
            ("2", ts("2024-01-12 18:00"), "S1", "Q240065", "redeemed"),
            ("2", ts("2024-01-10 18:00"), "S1", "OTHER", "redeemed"),
        ],
        "campaign_reservation": [
            _rev("C1", "A1", "S1", 101, "E1", "1", V, 1, "2024-01-10 11:00"),
            _rev("C1", "A1", "S1", 101, "E1", "2", V, 1, "2024-01-10 12:00"),
            _rev("C1", "A1", "S1", 101, "E1", "3", V, 2, "2024-01-10 13:00"),
            _rev("C1", "A1", "S1", 101, "E1", "4", V, 2, "2024-01-10 14:00"),
            _rev("C1", "A1", "S1", 101, "E1", "5", X, 1, None),
            _rev("C1", "A1", "S1", 101, "E1", "6", R, 1, None),
            _rev("C1", "A1", "S1", 101, "E1", "7", None, 1, None),
            _rev("C9", "A1", "S1", 101, "E9", "2", V, 1, "2024-01-10 12:00"),
            _rev("C1", "A2", "S2", 102, "E1", "2", V, 1, "2024-01-11 09:00"),
            _rev("C1", "A1", "S3", 103, "E1", "2", V, 1, "2024-01-10 09:00"),
            _rev("C2", "A1", "S1", 101, "E2", "2", V, 1, "2024-01-12 09:00"),
        ],
        "member_order_detail": [
            _order("1", "2024-01-10", "S1", "O1", True, 1, "LCS", True, 1, 100),
            _order("1", "2024-01-10", "S1", "O1", True, 1, "LCS", True, 2, 50),
            _order("2", "2024-01-11", "S1", "O2", True, 1, "LCS", True, 1, 100),
            _order("2", "2024-01-15", "S1", "O3", True, 1, "LCS", False, 1, 50),
            _order("2", "2024-01-16", "S1", "O3", False, 1, "LCS", False, -1, -50),
            _order("3", "2024-01-10", "S1", "O4", True, 1, "LCS", False, 1, 30),
            _order("3", "2024-01-30", "S1", "O5", True, 1, "LCS", False, 1, 70),
            _order("4", "2024-01-09", "S1", "O6", True, 1, "LCS", False, 1, 60),
            _order("4", "2024-01-17", "S1", "O7", True, 1, "LCS", False, 1, 40),
            _order("1", "2024-01-10", "S2", "O8", True, 1, "LCS", False, 1, 500),
            _order("3", "2024-01-10", "S1", "O9", True, 1, "LBR", False, 1, 500),
            _order("4", "2024-02-09", "S1", "O10", True, 1, "LCS", False, 1, 20),
            _order("4", "2024-02-10", "S1", "O11", True, 1, "LCS", False, 1, 500),
            _order(None, "2024-01-10", "S1", "O12", True, 1, "LCS", False, 1, 500),
            _order("3", "2024-01-10", "S1", "O13", True, 0, "LCS", False, 1, 500),
        ],
    }


def repeat_rows() -> dict[str, list[tuple]]:
    """FIXTURES.md section 4: one campaign per repeat case."""
    vt = "2024-03-01 10:00"

    def rev(code, member, agent="A1", source=1, event="E1", when=vt):
        return _rev(code, agent, "S1", 101, event, member, V, source, when, name=code)

    def order(member, oid, amount=10, date="2024-03-01", first=False, qty=1):
        return _order(member, date, "S1", oid, True, 1, "LCS", first, qty, amount)

    return {
        "phy_store": [("S1", "LCS East", "East", "P1")],
        "app_store": [(101, "Shanghai", "Store One")],
        "campaign_code": [("K4", "LTP"), ("K5", "LTP"), ("K6", "LTP"), ("K7", "LTP"), ("K7", "MBB"),
                          ("K9", "LTP"), ("K10", "LTP"), ("K11", "LTP"), ("K12", "LTP")],
        "member_detail": [],
        "coupon_benefit": [],
        "campaign_reservation": [
            rev("K4", "11", source=1), rev("K4", "11", source=2),
            rev("K5", "12", agent="A1"), rev("K5", "13", agent="A2"),
            rev("K6", "14"), rev("K6", "15", when="2024-03-02 10:00"),
            rev("K7", "16"),
            rev("K9", "17", event=None),
            rev("K10", "18"),
            rev("K11", "19"),
            rev("K12", "20"),
        ],
        "member_order_detail": [
            order("11", "P4", 100, first=True),
            order("12", "P5a", 40, date="2024-03-03"),
            order("13", "P5b", 60, date="2024-03-04"),
            order("14", "P6a", 10),
            order("15", "P6b", 20, date="2024-03-02"),
            order("16", "P7", 80),
            order("17", "P9", 30),
            order("18", "P10a", 100),
            order("018", "P10b", 50),
            order("19", "P11", None),
            order("20", "P12", 70, qty=0),
        ],
    }
