"""Windowed attribution by one sorted sweep (the other form of OP-7).

The range join of ``attribution`` pairs every visit with every order day in
its largest window before it aggregates.  Here visits and order days of a
(member, store) stand in one ordering by day, and each visit's statistics are
aggregates over the range frame from its day to ``w`` days later.  No pair is ever
made and no order day is copied to a neighbouring bucket: the two inputs are
shuffled once, together.  A frame holds at most ``w + 1`` order days for each text
variant of the member, whatever the data volume.

Results equal ``attribution.visit_window_stats``; ``Params.attribution`` chooses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import Params

_STATS = "crm_member_id", "order_rrp_amt", "has_eff_order", "trans_cnt", "initial_purchase"


def visit_window_sweep(visits: DataFrame, daily: DataFrame, params: Params = Params()) -> DataFrame:
    """Per visit key (member_key, store_id, event_dt) the columns ``n_w``,
    ``amt_w``, ``ord_w``, ``hi_w`` and ``lo_w`` of each window w, for keys with at
    least one order day in the largest window."""
    orders = daily.select("member_key", F.col("lego_store_code").alias("store_id"), F.unix_date("order_day").alias("_day"),
                          F.lit(True).alias("_order"), *_STATS).where("member_key IS NOT NULL AND store_id IS NOT NULL AND _day IS NOT NULL")
    types = dict(orders.dtypes)
    days = visits.select("member_key", "store_id", F.unix_date("event_dt").alias("_day"), F.lit(False).alias("_order"),
                         *[F.lit(None).cast(types[c]).alias(c) for c in _STATS])
    ordered = Window.partitionBy("member_key", "store_id").orderBy("_day")
    eff = F.col("_order") & F.col("has_eff_order")
    stats = {}
    for w in params.windows:
        frame = ordered.rangeBetween(Window.currentRow, w)
        flag = F.when(eff, F.col("initial_purchase"))
        stats |= {
            # Distinct (member text, first-order flag) pairs: a few at most.
            f"n_{w}": F.size(F.collect_set(F.when(eff, F.struct("crm_member_id", "initial_purchase"))).over(frame)).cast("long"),
            f"amt_{w}": F.sum("order_rrp_amt").over(frame),
            f"ord_{w}": F.sum(F.when(eff, F.col("trans_cnt"))).over(frame),
            f"hi_{w}": F.max(flag).over(frame),
            f"lo_{w}": F.min(flag).over(frame),
        }
    met = F.max("_order").over(ordered.rangeBetween(Window.currentRow, params.max_window))
    swept = days.unionByName(orders).withColumns(stats | {"_met": met})
    return swept.where("NOT _order AND _met").select("member_key", "store_id", F.date_from_unix_date("_day").alias("event_dt"), *stats)
