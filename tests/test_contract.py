"""Output schemas, bad-input behaviour and the driver contract."""

from __future__ import annotations

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry_mod
from storelift import Params, Sources, campaign_performance, in_store_activity
from storelift.plans.queries import QUERIES
from storelift.operators.assemble import MAIN_COLUMNS, SIBLING_COLUMNS
from tests.compare import compare, duck_connect
from tests.fixtures import V, X, golden_rows

P = Params(batch_ts=dt.datetime(2024, 2, 1))
SMOKE = "/root/testdata/sf0.001"


def _with_reservation(rows, *extra):
    rows = {k: list(v) for k, v in rows.items()}
    rows["campaign_reservation"] += list(extra)
    return rows


def test_main_schema(spark):
    df = campaign_performance(Sources.from_rows(spark, golden_rows()), P)
    assert tuple(df.columns) == MAIN_COLUMNS and len(df.columns) == 82
    types = {f.name: f.dataType for f in df.schema.fields}
    assert types["date_id"] == T.DateType()
    assert types["converted_rrp_amt_7_days"] == T.DecimalType(18, 2)
    assert types["CR_0_day"] == T.DoubleType()
    assert types["ttl_participants"] == T.LongType()
    assert types["dl_batch_date"] == T.StringType()
    assert types["dl_load_time"] == T.TimestampNTZType()


def test_sibling_schema(spark):
    df = in_store_activity(Sources.from_rows(spark, golden_rows()), P)
    assert tuple(df.columns) == SIBLING_COLUMNS and len(df.columns) == 18


def _bad_row(status):
    return ("C1", "Camp One", "A1", "S1", 101, "E1", "x1", status, 1, dt.datetime(2024, 1, 10, 11))


def test_bad_member_id_fails_on_verified_row(spark):
    src = Sources.from_rows(spark, _with_reservation(golden_rows(), _bad_row(V)))
    # One failing stage gives Spark's own error, several at once a wrapped one.
    with pytest.raises((NumberFormatException, Py4JJavaError)) as err:
        campaign_performance(src, Params(batch_ts=P.batch_ts, store_groups=False)).collect()
    assert "'x1'" in str(err.value) and "CAST_INVALID_INPUT" in str(err.value)


def test_bad_member_id_ignored_on_filtered_row(spark):
    src = Sources.from_rows(spark, _with_reservation(golden_rows(), _bad_row(X)))
    rows = campaign_performance(src, P).collect()
    assert len(rows) == 2


def test_bad_member_id_null_mode(spark):
    src = Sources.from_rows(spark, _with_reservation(golden_rows(), _bad_row(V)))
    p = Params(batch_ts=P.batch_ts, on_bad_id="null")
    rows = {r.campaign_code: r for r in campaign_performance(src, p).collect()}
    # The row counts as a participant (its text is a member id) but matches
    # no member, coupon or order.
    assert rows["C1"].ttl_participants == 5
    assert rows["C1"].converted_member_0_days == 2


def test_load_stamps_default_to_now(spark):
    rows = campaign_performance(Sources.from_rows(spark, golden_rows()), Params()).collect()
    today = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d")
    assert rows[0].dl_batch_date in (today, (dt.datetime.now() - dt.timedelta(days=1)).strftime("%Y%m%d"))


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert tuple(df.columns) == MAIN_COLUMNS
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_matches_oracle(spark, name):
    con = duck_connect(SMOKE)
    sql = entry_mod.oracle_sql()[name]
    assert compare(entry_mod.queries()[name](spark, SMOKE), con, sql, exact=True) == []


def test_role_mapping_counts_match_fixtures(spark):
    """Row counts that FIXTURES.md section 2 gives for sf0.01."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    q = entry_mod.queries()
    part = q["participations_main"](spark, sf)
    assert part.count() == 2485
    assert q["participation_metrics"](spark, sf).count() == 1927
    assert q["participations_sibling"](spark, sf).count() == 641
    assert q["in_store_activity"](spark, sf).count() == 799
    # Converted participation rows per window (each group stands for `mult`
    # distinct participation rows).
    for w, expected in ((0, 264), (7, 1357), (30, 1806)):
        got = q[f"attribution_{w}d"](spark, sf).agg(F.sum(F.col("mult") * F.col(f"converted_{w}"))).first()[0]
        assert got == expected, (w, got)


def test_packed_text_order_dates(spark):
    """A text date_id like '20240110' works with order_date_format."""
    from pyspark.sql import functions as F

    src = Sources.from_rows(spark, golden_rows())
    packed = src.member_order_detail.withColumn("date_id", F.date_format("date_id", "yyyyMMdd"))
    src2 = Sources(**{**{n: getattr(src, n) for n in ("campaign_reservation", "phy_store", "app_store",
                                                        "member_detail", "campaign_code", "coupon_benefit")},
                      "member_order_detail": packed})
    p = Params(batch_ts=P.batch_ts, order_date_format="yyyyMMdd")
    want = sorted(tuple(r) for r in campaign_performance(src, P).collect())
    got = sorted(tuple(r) for r in campaign_performance(src2, p).collect())
    assert got == want


def test_refresh_job_end_to_end(spark, tmp_path):
    """The job reads inputs from files and fully refreshes both tables."""
    from storelift import job
    from storelift.sources.schemas import SCHEMAS

    mem = Sources.from_rows(spark, golden_rows())
    args = []
    for role in SCHEMAS:
        getattr(mem, role).write.mode("overwrite").parquet(str(tmp_path / "in" / role))
        args += ["--path", f"{role}={tmp_path / 'in' / role}"]
    args += ["--main-table", "job_main", "--sibling-table", "job_sibling", "--location", str(tmp_path / "out"),
             "--batch-ts", "2024-02-01T00:00:00"]
    for _ in range(2):  # first run creates, second overwrites
        assert job.main(args) == 0
    assert spark.table("job_main").count() == 2
    assert spark.table("job_sibling").count() == 1
    assert tuple(spark.table("job_main").columns) == MAIN_COLUMNS


def test_dimension_key_report(spark):
    from storelift.operators.diagnostics import dimension_key_report

    got = {r.dimension: (r.rows, r.distinct_keys, r.repeated_keys, r.extra_rows)
           for r in dimension_key_report(Sources.from_rows(spark, golden_rows())).collect()}
    assert got == {"phy_store": (3, 3, 0, 0), "app_store": (2, 2, 0, 0),
                   "member_detail": (4, 3, 1, 1), "campaign_code": (2, 2, 0, 0)}


def test_member_tag_of_each_member_row(spark):
    """A member registered at two stores at once gives both tags; a member
    that joined earlier, or is unknown, gives 0."""
    from storelift.operators.participations import member_rows, new_member_tag

    visits = spark.createDataFrame(
        [(k, "S1", dt.date(2024, 1, 10)) for k in (1, 2, 3, 4)], "member_key long, store_id string, event_dt date")
    members = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 10, 9), "S1"), ("1", dt.datetime(2024, 1, 10, 9), "S2"), ("01", dt.datetime(2024, 1, 10, 9), "S1"),
         ("2", dt.datetime(2024, 1, 10, 9), "S1"), ("3", dt.datetime(2024, 1, 9, 9), "S1"), (None, dt.datetime(2024, 1, 9, 9), "S1")],
        "member_detail_id string, join_time timestamp_ntz, eff_reg_store string")
    rows = member_rows(members, P)
    assert rows.count() == 4
    tagged = new_member_tag(visits.join(rows, visits.member_key == rows._mbr_key, "left"))
    assert sorted((r.member_key, r.new_member_tag) for r in tagged.collect()) == [(1, 0), (1, 1), (2, 1), (3, 0), (4, 0)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_declared_test_table_schemas(spark, sf):
    """The schemas declared for the test tables equal the files' own."""
    from pyspark.sql.types import _parse_datatype_string

    from storelift.sources.testdata import TABLE_SCHEMAS

    for name, ddl in TABLE_SCHEMAS.items():
        inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
        declared = _parse_datatype_string(ddl)
        assert [(f.name, f.dataType) for f in inferred.fields] == [(f.name, f.dataType) for f in declared.fields]


def test_refresh_inserts_by_position(spark, tmp_path):
    """An existing target is overwritten by column position, as the source's
    insert without a column list."""
    from storelift.sinks.refresh import refresh

    spark.sql(f"CREATE TABLE pos_target (label STRING, n BIGINT) USING parquet LOCATION '{tmp_path / 't'}'")
    spark.sql("INSERT INTO pos_target VALUES ('old', 1)")
    refresh(spark.createDataFrame([("x", 5), ("y", 6)], "other_name string, other_count bigint"), "pos_target")
    assert sorted(tuple(r) for r in spark.table("pos_target").collect()) == [("x", 5), ("y", 6)]


def test_refresh_job_rejects_incomplete_inputs():
    from storelift import job

    with pytest.raises(SystemExit):
        job.main(["--path", "phy_store=/nowhere", "--main-table", "t"])
    with pytest.raises(SystemExit):
        job.main(["--path", "not_a_role=/nowhere", "--main-table", "t"])


def test_refresh_replaces_every_partition(spark, tmp_path):
    """A partitioned target is replaced as a whole in dynamic mode too."""
    from storelift.sinks.refresh import refresh

    spark.sql(f"CREATE TABLE part_target (n BIGINT, label STRING) USING parquet PARTITIONED BY (label) LOCATION '{tmp_path / 'p'}'")
    spark.sql("INSERT INTO part_target VALUES (1, 'a'), (2, 'b')")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        refresh(spark.createDataFrame([(3, "b")], "anything bigint, day string"), "part_target")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [tuple(r) for r in spark.table("part_target").collect()] == [(3, "b")]


def test_refresh_roundtrip_leaves_no_table(spark):
    import os

    from storelift.session import shared_dir

    before = spark.catalog.listTables()
    assert QUERIES["refresh_roundtrip"](spark, SMOKE).count() == 67
    assert len(spark.catalog.listTables()) == len(before)
    tables = shared_dir(spark).removeprefix("file:") + "/tables"
    assert not os.path.isdir(tables) or os.listdir(tables) == []


def test_reports_leave_nothing_after_drop_and_one_folder(spark):
    import os

    from storelift.session import drop_stored, shared_dir

    folder = shared_dir(spark)
    for _ in range(3):
        campaign_performance(Sources.from_rows(spark, golden_rows()), P).collect()
        assert shared_dir(spark) == folder
    drop_stored(spark)
    assert not os.path.exists(folder.removeprefix("file:") + "/stored")


def test_sources_from_catalog(spark, tmp_path):
    from storelift.sources.schemas import SCHEMAS

    mem = Sources.from_rows(spark, golden_rows())
    for role in SCHEMAS:
        getattr(mem, role).write.option("path", str(tmp_path / role)).mode("overwrite").saveAsTable(f"cat_{role}")
    src = Sources.from_catalog(spark, {role: f"cat_{role}" for role in SCHEMAS})
    want = sorted(map(tuple, campaign_performance(mem, P).collect()))
    assert sorted(map(tuple, campaign_performance(src, P).collect())) == want


def test_wrong_input_types_are_named_up_front(spark):
    mem = Sources.from_rows(spark, golden_rows())
    parts = {f: getattr(mem, f) for f in ("campaign_reservation", "phy_store", "app_store", "member_detail", "campaign_code",
                                          "coupon_benefit", "member_order_detail")}
    parts["member_order_detail"] = mem.member_order_detail.withColumn("order_rrp_amt", F.col("order_rrp_amt").cast("double"))
    parts["app_store"] = mem.app_store.withColumn("store_id", F.col("store_id").cast("string")).drop("name")
    with pytest.raises(ValueError) as err:
        Sources(**parts)
    for text in ("member_order_detail.order_rrp_amt is double", "app_store.store_id is string", "app_store lacks column name"):
        assert text in str(err.value)


def test_submitted_configuration_is_kept(tmp_path):
    """Time zone, adaptive execution and driver memory given at submission
    stay; a zone-aware check-in near midnight falls on the submitted zone's day."""
    import os
    import subprocess
    import sys

    code = """
import datetime as dt
from storelift.session import get_session
from storelift.functions.expr import day_of
s = get_session()
c = s.sparkContext.getConf()
print("GOT", s.conf.get("spark.sql.session.timeZone"), s.conf.get("spark.sql.adaptive.enabled"), c.get("spark.driver.memory"),
      s.sql("SELECT timestamp'2024-01-10T17:30:00Z' AS t").select(day_of("t")).first()[0])
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PYSPARK_SUBMIT_ARGS":
                        "--master local[1] --driver-memory 1g --conf spark.sql.session.timeZone=Asia/Shanghai "
                        "--conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180, cwd=tmp_path).stdout
    assert "GOT Asia/Shanghai false 1g 2024-01-11" in out


def test_packed_text_days_prune_the_scan(spark, tmp_path):
    """Text days in a sortable format reach the scan as a text bound."""
    from storelift.plans.reports import attributable_orders, prepare

    mem = Sources.from_rows(spark, golden_rows())
    mem.member_order_detail.withColumn("date_id", F.date_format("date_id", "yyyyMMdd")).write.parquet(str(tmp_path / "o"))
    parts = {f: getattr(mem, f) for f in ("campaign_reservation", "phy_store", "app_store", "member_detail", "campaign_code", "coupon_benefit")}
    src = Sources(**parts, member_order_detail=spark.read.parquet(str(tmp_path / "o")))
    p = Params(order_date_format="yyyyMMdd")
    plan = attributable_orders(src, p, prepare(src, p).days)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_id,20240110)" in plan and "LessThanOrEqual(date_id,20240211)" in plan
