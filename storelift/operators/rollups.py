"""Daily roll-ups of the order-line fact (OP-5, OP-6).

For the reports the order lines are read once and rolled up once into one row
per (member text, day, store) carrying both the effective-order figures and the
net sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.broadcast import broadcast_if_small
from ..functions.expr import day_of, flag, member_key, positive_amount, returned_amount
from ..params import Params

DAY_KEYS = ("crm_member_id", "date_id", "lego_store_code")


def attributable_lines(orders: DataFrame, params: Params) -> DataFrame:
    """Order lines that can be attributed: retail-price sales of members,
    outside the excluded distributor (a NULL distributor is excluded too)."""
    return orders.filter(
        (F.col("is_rrp_sales_type") == 1)
        & (F.col("distributor_name") != params.excluded_order_distributor)
        & F.col("crm_member_id").isNotNull()
    )


def at_stores(orders: DataFrame, stores: DataFrame, params: Params = Params()) -> DataFrame:
    """The lines of the given stores (column store_code): only they can meet a
    visit, so the others are dropped before the roll-up's first shuffle."""
    codes = broadcast_if_small(stores.withColumnRenamed("store_code", "lego_store_code").distinct(), params.broadcast_max_bytes)
    return orders.join(codes, "lego_store_code", "left_semi")


def daily_activity(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per (crm_member_id, date_id, lego_store_code) with

    * ``order_rrp_amt``: net amount of all lines, returns subtracted
      (NULL when every positive-quantity line has a NULL amount),
    * ``has_eff_order``: at least one effective line that day,
    * ``trans_cnt``: distinct effective orders,
    * ``initial_purchase``: 1 if an effective line is the member's first
      order, 0 if not, NULL without effective lines,
    * ``member_key`` and ``order_day``: integer member id and calendar day,
      the join keys of the attribution.

    Two aggregation steps, both with map-side partial aggregation: first per
    order, shuffled on (member, day, store, order), then per day.  Counting
    distinct orders this way needs no Expand, and a member-day-store with a
    very large number of orders is spread over many tasks in the first step.
    """
    lines = attributable_lines(orders, params)
    eff = F.col("if_eff_order_tag").eqNullSafe(True)
    per_order = lines.groupBy(*DAY_KEYS, "original_order_id").agg(
        F.sum(positive_amount("sales_qty", "order_rrp_amt")).alias("_pos"),
        F.sum(returned_amount("sales_qty", "order_rrp_amt")).alias("_neg"),
        F.max(eff.cast("int")).alias("_eff"),
        F.max(F.when(eff, flag(F.col("initial_vs_repurchase_lifecycle") == params.first_order_lifecycle)))
        .alias("_first"),
    )
    per_day = per_order.groupBy(*DAY_KEYS).agg(
        (F.sum("_pos") - F.sum("_neg")).alias("order_rrp_amt"),
        (F.max("_eff") == 1).alias("has_eff_order"),
        F.count(F.when(F.col("_eff") == 1, F.col("original_order_id"))).alias("trans_cnt"),
        F.max("_first").alias("initial_purchase"),
    )
    return per_day.withColumns({
        "member_key": member_key("crm_member_id", params).cast("long"),
        "order_day": day_of("date_id", params.order_date_format),
    })


def daily_orders(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Effective orders per member, day and store: distinct order count and
    whether one of them is the member's first order."""
    return daily_activity(orders, params).filter("has_eff_order").select(
        *DAY_KEYS, "trans_cnt", "initial_purchase"
    )


def daily_net_sales(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """Net retail amount per member, day and store: positive-quantity lines
    minus the absolute amount of negative-quantity lines, all orders.  One
    partially aggregated step: no order is told apart."""
    net = (F.sum(positive_amount("sales_qty", "order_rrp_amt")) - F.sum(returned_amount("sales_qty", "order_rrp_amt")))
    return attributable_lines(orders, params).groupBy(*DAY_KEYS).agg(net.alias("order_rrp_amt"))
