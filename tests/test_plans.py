"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid

import pytest

from storelift import Params, Sources, campaign_performance, in_store_activity
from storelift.operators.rollups import daily_net_sales
from storelift.plans.reports import attributed_groups, prepare
from storelift.sources.schemas import SCHEMAS
from tests.fixtures import golden_rows

P = Params(batch_ts=dt.datetime(2024, 2, 1))


@pytest.fixture(scope="module")
def file_sources(spark):
    """The golden rows written as parquet, one folder per input, so scans
    show up as file scans in the plan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    root = tempfile.mkdtemp(prefix="storelift-plan-")
    mem = Sources.from_rows(spark, golden_rows())
    paths = {}
    for name in SCHEMAS:
        paths[name] = f"{root}/{name}"
        getattr(mem, name).write.mode("overwrite").parquet(paths[name])
    return Sources.from_paths(spark, paths)


def executed_plan(df) -> str:
    """The final adaptive plan, after running the query itself."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def final_part(plan: str) -> str:
    # AQE prints the final plan, then the initial plan; keep the final one, without the plans of subqueries.
    lines, deeper = [], None
    for line in re.split(r"(?m)^\+- == Initial Plan ==", plan)[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if deeper is not None and depth > deeper:
            continue
        deeper = depth if re.match(r"[ :]*[:+]- Subquery subquery#", line) else None
        lines.append(line)
    return "\n".join(lines)


def scans_of(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\]", plan))


def jobs_of(spark, run) -> int:
    """How many Spark jobs ``run`` starts."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_reservation_fact_read_once(spark, file_sources):
    """One pass stores the rows in use and the visit keys; with it, building
    the groups' plan runs no job and reads no reservations."""
    prepared = prepare(file_sources, P)
    assert prepared.days == (dt.date(2024, 1, 10), dt.date(2024, 1, 12)) and prepared.visitors == 4
    assert jobs_of(spark, lambda: attributed_groups(file_sources, P, prepared)) == 0
    for df in (attributed_groups(file_sources, P, prepared), campaign_performance(file_sources, P, prepared),
               in_store_activity(file_sources, P, prepared)):
        assert scans_of(final_part(executed_plan(df)), "campaign_reservation") == 0


def test_order_fact_read_once(file_sources):
    # The attributed groups are the stored part of the main report.
    plan = final_part(executed_plan(attributed_groups(file_sources, P)))
    assert scans_of(plan, "member_order_detail") == 1
    assert scans_of(plan, "campaign_reservation") == 0
    assert len(re.findall(r"FileScan parquet [^\n]*stored/reservations-", plan)) == 1
    assert scans_of(plan, "member_detail") == 1
    assert scans_of(plan, "coupon_benefit") == 1


def test_no_set_collection(file_sources):
    for df in (attributed_groups(file_sources, P), in_store_activity(file_sources, P)):
        plan = final_part(executed_plan(df))
        assert "ObjectHashAggregate" not in plan and "collect_set" not in plan


def test_shuffles_bounded(spark, file_sources):
    """With the lookups broadcast and every other join shuffled: exchanges of
    the groups, and of the report after them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = P
        groups = final_part(executed_plan(attributed_groups(file_sources, p)))
        report = final_part(executed_plan(campaign_performance(file_sources, p)))
        sales = final_part(executed_plan(daily_net_sales(file_sources.member_order_detail, p)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    count = lambda plan: len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))
    assert count(groups) <= 13 and count(report) <= 9 and count(sales) == 1


def test_store_filter_below_the_first_exchange(file_sources):
    plan = final_part(executed_plan(attributed_groups(file_sources, P)))
    lines = plan.splitlines()
    scan = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "member_order_detail]" in ln)
    above = [ln for ln in lines[:scan] if "LeftSemi" in ln or "Exchange hashpartitioning(crm_member_id" in ln]
    assert "LeftSemi" in above[-1], above


def test_member_filter_below_the_first_exchange(file_sources):
    plan = final_part(executed_plan(attributed_groups(file_sources, P)))
    lines = plan.splitlines()
    scan = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "member_order_detail]" in ln)
    above = [ln for ln in lines[:scan] if ("Filter" in ln and "try_cast" in ln and "xxhash64" in ln) or "Exchange hashpartitioning(crm_member_id" in ln]
    assert "Filter" in above[-1], above


def test_report_reads_stored_groups_not_sources(file_sources):
    plan = final_part(executed_plan(campaign_performance(file_sources, P)))
    assert scans_of(plan, "member_order_detail") == 0
    assert scans_of(plan, "campaign_reservation") == 0


def test_no_expand_cartesian_or_python(file_sources):
    inline = Params(batch_ts=P.batch_ts, store_groups=False)
    for df in (campaign_performance(file_sources, inline), in_store_activity(file_sources, P),
               attributed_groups(file_sources, P)):
        plan = final_part(executed_plan(df))
        for bad in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                    "ArrowEvalPython", "Window ["):
            assert bad not in plan, bad


def test_filters_and_columns_pushed_to_scan(spark, file_sources):
    plan = final_part(executed_plan(attributed_groups(file_sources, P)))
    line = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "member_order_detail]" in ln][0]
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line).group(1)
    for f in ("IsNotNull(crm_member_id)", "EqualTo(is_rrp_sales_type,1)", "Not(EqualTo(distributor_name,LBR))",
              "GreaterThanOrEqual(date_id,2024-01-10)", "LessThanOrEqual(date_id,2024-02-11)"):
        assert f in pushed, (f, pushed)
    # Only the ten used columns are read.
    schema = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
    assert schema.count(":") == 10


def test_reports_read_the_stored_groups(file_sources):
    plan = final_part(executed_plan(campaign_performance(file_sources, P)))
    # base_0 reads the groups; the two window joins read the window report.
    assert len(re.findall(r"FileScan parquet [^\n]*attributed-groups", plan)) == 1
    assert len(re.findall(r"FileScan parquet [^\n]*window-report", plan)) == 2


def test_broadcast_only_below_the_bytes(spark):
    from storelift.functions.broadcast import broadcast_if_small, estimated_bytes

    small = spark.range(5).withColumnRenamed("id", "k")
    large = spark.range(50_000).withColumnRenamed("id", "k")
    bound = 1000
    assert estimated_bytes(small) <= bound < estimated_bytes(large)
    fact = spark.range(1000).selectExpr("id % 50 AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_small = fact.join(broadcast_if_small(small, bound), "k")._jdf.queryExecution().executedPlan().toString()
        plan_large = fact.join(broadcast_if_small(large, bound), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan_small
    assert "BroadcastHashJoin" not in plan_large
