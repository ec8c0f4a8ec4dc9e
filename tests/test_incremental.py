"""Incremental runs give the full run's table and compute only the days whose inputs changed."""

from __future__ import annotations

import datetime as dt
import functools
import os
import random
from decimal import Decimal

import pytest

from storelift import Params, Sources, campaign_performance
from storelift.plans import incremental as I
from tests.fixtures import FIRST, REPEAT, V
from tests.test_random import random_rows

P = Params(batch_ts=dt.datetime(2024, 2, 1))


def table(df):
    return sorted(map(str, df.collect()))


def run(spark, rows, folder, params=P, full=True):
    src = Sources.from_rows(spark, rows)
    report, touched = I.incremental_campaign_performance(src, folder, params)
    if full:
        assert table(report) == table(campaign_performance(src, params))
    return touched


def changed(rows, rnd):
    """One random change of each kind."""
    rows = {k: list(v) for k, v in rows.items()}
    rev, orders = rows["campaign_reservation"], rows["member_order_detail"]
    kind = rnd.choice(["visit", "late line", "amount", "gone line", "gone visit", "member", "coupon", "status"])
    if kind == "visit":
        r = rnd.choice(rev)
        rev.append((*r[:6], str(rnd.randint(1, 8)), V, 1, dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=rnd.randint(0, 90))))
    elif kind == "late line":
        orders.append((str(rnd.randint(1, 8)), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 70)), rnd.choice(["S1", "S2"]), "late", True, 1,
                       "LCS", rnd.choice([FIRST, REPEAT]), 1, Decimal("12.50")))
    elif kind == "amount":
        k = rnd.randrange(len(orders))
        orders[k] = (*orders[k][:9], Decimal("99.75"))
    elif kind in ("gone line", "gone visit"):
        own = orders if kind == "gone line" else rev
        own.pop(rnd.randrange(len(own)))
    elif kind == "member":
        rows["member_detail"].append((str(rnd.randint(1, 8)), dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=rnd.randint(0, 70)), rnd.choice(["S1", "S2"])))
    elif kind == "coupon":
        r = rnd.choice([r for r in rev if r[6] and r[9]])
        rows["coupon_benefit"].append((r[6], r[9], r[3], "Q240065", "redeemed"))
    else:
        k = rnd.randrange(len(rev))
        rev[k] = (*rev[k][:7], rnd.choice([V, None]), *rev[k][8:])
    return rows


@pytest.mark.parametrize("seed", [51, 52])
def test_random_changes(spark, tmp_path, seed):
    rnd, rows, folder = random.Random(seed), random_rows(seed), str(tmp_path / "state")
    first = run(spark, rows, folder, full=False)
    assert first.total == len(first.days) > 20
    for _ in range(3):
        rows = changed(changed(rows, rnd), rnd)
        touched = run(spark, rows, folder)
        assert len(touched.days) < touched.total
    assert run(spark, rows, folder, full=False).days == ()
    assert len(os.listdir(f"{folder}/manifests")) <= 2 * 2  # files and their checksums


def two_visits():
    rows = random_rows(60)
    base = [r for r in rows["campaign_reservation"] if r[6] and r[9]][0]
    visit = lambda day, member: ("C1", "Camp C1", "A1", "S1", 1, "E1", member, V, 1, dt.datetime(2024, 1, day, 10))
    assert base
    rows |= {"campaign_reservation": [visit(1, "1"), visit(5, "2"), visit(30, "1"), (*visit(2, "3")[:9], None)], "member_detail": [], "coupon_benefit": [],
             "member_order_detail": [("1", dt.date(2024, 1, 3), "S1", "O1", True, 1, "LCS", FIRST, 1, Decimal("10.00"))]}
    return rows


def line(day, member="2", store="S1"):
    return (member, dt.date(2024, 1, 1) + dt.timedelta(days=day - 1), store, f"L{day}", True, 1, "LCS", REPEAT, 1, Decimal("7.00"))


def test_only_days_whose_window_meets_the_change(spark, tmp_path):
    folder, rows = str(tmp_path / "state"), two_visits()
    run = functools.partial(globals()["run"], full=False)
    day = lambda n: dt.date(2024, 1, n)
    assert run(spark, rows, folder).days == (I.NO_DAY, day(1), day(5), day(30))
    rows["member_order_detail"].append(line(33))  # 2 February: windows of the 5th and the 30th, not of the 1st
    assert run(spark, rows, folder).days == (day(5), day(30))
    rows["member_order_detail"].append(line(31))  # 31 January: the first day's 30th day
    assert run(spark, rows, folder).days == (day(1), day(5), day(30))
    rows["member_order_detail"].append(line(36, store="S3"))  # a store of the other distributor
    assert run(spark, rows, folder).days == ()
    rows["member_detail"].append(("2", dt.datetime(2024, 1, 5, 9), "S1"))
    assert run(spark, rows, folder).days == (day(5),)
    rows["coupon_benefit"].append(("1", dt.datetime(2024, 1, 30, 20), "S1", "Q240065", "redeemed"))
    assert run(spark, rows, folder).days == (day(30),)
    rows["campaign_reservation"].pop(1)
    gone = run(spark, rows, folder, full=True)
    assert gone.days == () and gone.gone == (day(5),)
    rows["campaign_reservation"].append(("C1", "Camp C1", "A1", "S1", 1, "E1", "8", "waiting", 1, None))  # counted, without a day
    assert run(spark, rows, folder).days == ()
    rows["campaign_code"].append(("C7", "LTP"))
    assert run(spark, rows, folder).reasons == {"lookups or settings": 3}
    assert run(spark, rows, folder, Params(batch_ts=P.batch_ts, parity=False), full=True).reasons == {"lookups or settings": 3}


def test_runs_are_written_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MAX_RUNS", 2)
    folder, rows = str(tmp_path / "state"), two_visits()
    run(spark, rows, folder, full=False)
    for k in (40, 45, 50):
        rows["member_order_detail"].append(line(k, member="1"))
        run(spark, rows, folder, full=k == 50)
        assert len(set(I.load_state(spark, folder).days.values())) <= 2
        assert len([n for n in os.listdir(f"{folder}/runs")]) <= 3


def test_a_run_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    folder, rows = str(tmp_path / "state"), two_visits()
    run(spark, rows, folder, full=False)
    before = I.load_state(spark, folder)
    rows["member_order_detail"].append(line(40, member="1"))
    with monkeypatch.context() as m:
        m.setattr(I, "write_text", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            I.incremental_campaign_performance(Sources.from_rows(spark, rows), folder, P)
    assert I.load_state(spark, folder) == before and len(os.listdir(f"{folder}/runs")) == 2
    assert run(spark, rows, folder).days == (dt.date(2024, 1, 30),)
    assert len(os.listdir(f"{folder}/runs")) == 2


def test_no_visits_at_all(spark, tmp_path):
    rows = two_visits() | {"campaign_reservation": []}
    assert run(spark, rows, str(tmp_path / "state")).days == ()
    assert run(spark, two_visits(), str(tmp_path / "state")).total == 4


def test_a_day_is_written_once(spark, tmp_path):
    """Files by the number of days, not of days times tasks."""
    rows = spark.range(600).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS date_id").repartition(6)
    I._write_days(rows, str(tmp_path / "rows"))
    folders = [d for d in os.listdir(tmp_path / "rows") if d.startswith("_day=")]
    assert len(folders) == 5
    assert all(len([f for f in os.listdir(tmp_path / "rows" / d) if f.endswith(".parquet")]) == 1 for d in folders)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 600


def test_hash_sum_is_exact(spark):
    """The long pieces give the decimal sum of the signed hashes, as earlier states hold it."""
    rows = spark.range(5000).selectExpr("id", "id % 3 AS k")
    plain = rows.selectExpr("k", "CAST(xxhash64(id) AS DECIMAL(20,0)) AS h").groupBy("k").sum("h").collect()
    assert {r[0]: str(r[1]) for r in plain} == {r[0]: str(r[1]) for r in rows.groupBy("k").agg(I._hash_sum(["id"]).cast("string")).collect()}
    assert rows.where("false").agg(I._hash_sum(["id"])).first()[0] is None
