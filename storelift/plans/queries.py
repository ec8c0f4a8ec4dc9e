"""Named queries over the generated test tables (one per operator of the
inventory), each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables through the role mapping of
``sources.testdata``; none caps, samples or filters rows to stay cheap.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import member_key, day_of
from ..operators.attribution import conversion_columns
from ..operators.diagnostics import dimension_key_report
from ..operators.metrics import (
    BASE_KEYS, GROUP_KEYS_0, GROUP_KEYS_W, WINDOW_KEYS, conversion_metric_columns, cr_name, kpi_ratios,
    participation_metrics, same_day_report, window_report,
)
from ..operators.participations import flag_redemption, participation_rows, participations
from ..operators.reservations import count_reservations
from ..operators.rollups import daily_net_sales, daily_orders
from ..params import Params
from ..session import drop_path, shared_dir, stored
from ..sinks.refresh import refresh, scratch_table
from ..sources import testdata
from . import lineitem as LI
from .incremental import incremental_campaign_performance
from .reports import attributed_groups, campaign_performance, in_store_activity

# Fixed load time of the registered queries, so results are repeatable.
BATCH_TS = _dt.datetime(2024, 2, 1)
PARAMS = Params(batch_ts=BATCH_TS)

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str):
    return testdata.sources(spark, sf_dir)


def q_reservation_counts(spark, sf_dir):
    return count_reservations(_src(spark, sf_dir).campaign_reservation, PARAMS)


def q_participations_main(spark, sf_dir):
    return participations(_src(spark, sf_dir), PARAMS, "main")


def q_participations_sibling(spark, sf_dir):
    return participations(_src(spark, sf_dir), PARAMS, "sibling")


def q_coupon_flag(spark, sf_dir):
    """Coupon flag of every verified reservation of a listed campaign."""
    src = _src(spark, sf_dir)
    rev = src.campaign_reservation.filter(F.col("res_status") == PARAMS.verified_status)
    camp = src.campaign_code.select("campaign_code", "campaign_type")
    rows = rev.join(camp, "campaign_code", "inner").select(
        "campaign_code", "campaign_type",
        F.col("store_code").alias("store_id"),
        day_of("verification_time").alias("event_dt"),
        F.col("type_value").alias("member_id"),
        member_key("type_value", PARAMS).alias("member_key"),
    ).distinct()
    return flag_redemption(rows, src.coupon_benefit, PARAMS).drop("member_key")


def q_daily_orders(spark, sf_dir):
    return daily_orders(_src(spark, sf_dir).member_order_detail, PARAMS)


def q_daily_net_sales(spark, sf_dir):
    return daily_net_sales(_src(spark, sf_dir).member_order_detail, PARAMS).withColumn(
        "order_rrp_amt", F.col("order_rrp_amt").cast("decimal(18,2)"))


def _one_window(w: int, params: Params = PARAMS) -> Params:
    """Only window ``w`` is joined and aggregated."""
    return dataclasses.replace(params, windows=(w,))


def _attribution(w: int, params: Params) -> Query:
    def run(spark, sf_dir):
        groups = attributed_groups(_src(spark, sf_dir), _one_window(w, params))
        if w == 0:
            keys = list(GROUP_KEYS_0)
        else:
            keys = list(GROUP_KEYS_W)
            stats = [F.max(f"{s}_{w}").alias(f"{s}_{w}") for s in ("n", "amt", "ord", "hi", "lo")]
            groups = groups.groupBy(*keys, "member_key").agg(F.sum("mult").alias("mult"), *stats)
        cols = conversion_columns(w, "mult", params)
        out = groups.select(*keys, F.col("mult").cast("long").alias("mult"), *cols.values())
        return out.withColumn(f"rrp_amt_{w}", F.col(f"rrp_amt_{w}").cast("decimal(18,2)"))
    return run


def q_participation_metrics(spark, sf_dir):
    rows = participation_rows(_src(spark, sf_dir), PARAMS, "main")
    return participation_metrics(rows, BASE_KEYS, with_coupon=True, params=PARAMS)


def q_conversion_metrics_0d(spark, sf_dir):
    base = same_day_report(attributed_groups(_src(spark, sf_dir), _one_window(0)), PARAMS, 0)
    return base.select(*BASE_KEYS, *conversion_metric_columns(0))


def _conversion_metrics(w: int) -> Query:
    def run(spark, sf_dir):
        base = window_report(attributed_groups(_src(spark, sf_dir), _one_window(w)), PARAMS, (w,))
        return base.select(*WINDOW_KEYS, *conversion_metric_columns(w))
    return run


def q_kpi_ratios(spark, sf_dir):
    base = kpi_ratios(same_day_report(attributed_groups(_src(spark, sf_dir), _one_window(0)), PARAMS, 0), 0)
    seg = ("", "new_", "existing_")
    ratios = ([cr_name(0, s) for s in seg] + [f"converted_{s}member_aspp_0_days" for s in seg]
              + [f"converted_{s}member_atv_0_days" for s in seg])
    return base.select(*BASE_KEYS, *ratios)


def q_campaign_performance(spark, sf_dir):
    return campaign_performance(_src(spark, sf_dir), PARAMS)


def q_campaign_performance_incremental(spark, sf_dir):
    """The report by three runs on one state: without the last tenth of the
    reservations and order lines by day and with some amounts yet to be
    corrected, then with all inputs, then with nothing changed."""
    src = _src(spark, sf_dir)
    days = src.member_order_detail.select(F.unix_date("date_id").alias("d")).agg(F.min("d"), F.max("d")).first()
    cut = F.date_from_unix_date(F.lit(int(days[1] - (days[1] - days[0]) // 10)))
    early = dataclasses.replace(
        src, campaign_reservation=src.campaign_reservation.where(day_of("verification_time") < cut),
        member_order_detail=src.member_order_detail.where(F.col("date_id") < cut).withColumn(
            "order_rrp_amt", F.when(F.dayofmonth("date_id") == 11, F.lit(1)).otherwise(F.col("order_rrp_amt")).cast("decimal(18,2)")))
    folder = f"{shared_dir(spark)}/states/{uuid.uuid4().hex}"
    for inputs in (early, src, src):
        report, _ = incremental_campaign_performance(inputs, folder, PARAMS)
    report = stored(report, "incremental-report")
    drop_path(spark, folder)
    return report


def q_in_store_activity(spark, sf_dir):
    return in_store_activity(_src(spark, sf_dir), PARAMS)


def q_refresh_roundtrip(spark, sf_dir):
    """Load the sibling report twice by full refresh (create, then switch to
    new rows by position), read the table back and remove it."""
    name, location = scratch_table(spark, "in_store_activity")
    report = stored(in_store_activity(_src(spark, sf_dir), PARAMS), "roundtrip-report")
    for _ in range(2):
        refresh(report, name, location, journal=f"{location}_journal")
    back = stored(spark.table(name), "roundtrip")
    spark.sql(f"DROP TABLE {name}")
    drop_path(spark, location.rpartition("/")[0])
    return back


def q_load_stamp_check(spark, sf_dir):
    """Load stamps of a report built without a fixed time: one for all rows,
    between the start and the end of the run, and the batch date is its day."""
    clock = lambda: spark.range(1).select(F.localtimestamp()).first()[0]
    started = clock()
    report = stored(campaign_performance(_src(spark, sf_dir), Params()).select("dl_load_time", "dl_batch_date"), "stamped-report")
    ended = clock()
    stamp = F.col("dl_load_time")
    return report.agg(
        F.count(F.lit(1)).alias("report_rows"), F.count_distinct("dl_load_time").alias("stamps"),
        F.bool_and(stamp.between(F.lit(started).cast("timestamp_ntz"), F.lit(ended).cast("timestamp_ntz"))).alias("within_run"),
        F.bool_and(F.col("dl_batch_date") == F.date_format(stamp, "yyyyMMdd")).alias("batch_is_day"))


def q_dimension_key_check(spark, sf_dir):
    return dimension_key_report(_src(spark, sf_dir), PARAMS)


def q_lineitem_ship_window(spark, sf_dir):
    return LI.ship_windows(testdata.read_table(spark, sf_dir, "orders"),
                           testdata.read_table(spark, sf_dir, "lineitem"), PARAMS)


def q_lineitem_net_sales(spark, sf_dir):
    return LI.supplier_daily_net_sales(testdata.read_table(spark, sf_dir, "lineitem"))


QUERIES: dict[str, Query] = {
    "reservation_counts": q_reservation_counts,
    "participations_main": q_participations_main,
    "participations_sibling": q_participations_sibling,
    "coupon_flag": q_coupon_flag,
    "daily_orders": q_daily_orders,
    "daily_net_sales": q_daily_net_sales,
    "attribution_0d": _attribution(0, PARAMS),
    "attribution_7d": _attribution(7, PARAMS),
    "attribution_30d": _attribution(30, PARAMS),
    "attribution_clean_30d": _attribution(30, Params(batch_ts=BATCH_TS, parity=False)),
    "participation_metrics": q_participation_metrics,
    "conversion_metrics_0d": q_conversion_metrics_0d,
    "conversion_metrics_7d": _conversion_metrics(7),
    "conversion_metrics_30d": _conversion_metrics(30),
    "kpi_ratios": q_kpi_ratios,
    "campaign_performance": q_campaign_performance,
    "campaign_performance_incremental": q_campaign_performance_incremental,
    "in_store_activity": q_in_store_activity,
    "refresh_roundtrip": q_refresh_roundtrip,
    "load_stamp_check": q_load_stamp_check,
    "dimension_key_check": q_dimension_key_check,
    "lineitem_ship_window": q_lineitem_ship_window,
    "lineitem_net_sales": q_lineitem_net_sales,
}
