"""Windowed conversion attribution (OP-7).

A participation converts within ``w`` days when the same member has an
effective order at the same store 0..w days after the event day.  The source
query joins the order roll-ups six times (orders and net sales, for 0, 7 and
30 days).  Here the roll-up is built once (``rollups.daily_activity``) and
joined once, with the largest window, to the distinct visit keys
(member, store, day); every window is then a conditional aggregate.

The range join is an equi-join on (member, store, time bucket) plus a day
bound.  Buckets are ``bucket_days`` wide; an order day also joins the previous
bucket when it lies within ``max(windows)`` days of its bucket start.  Each
visit key is unique on its side, so the work per join key is bounded by the
calendar (at most ``bucket_days`` visits against ``bucket_days + max window``
order days per member variant), whatever the data volume of one member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import day_diff
from ..functions.sqlexpr import cols
from ..params import Params

VISIT_KEYS = ("member_key", "store_id", "event_dt")


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width)).cast("long")


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_day: str,
                right_day: str, max_days: int, bucket_days: int) -> DataFrame:
    """Inner range join: rows with equal ``keys`` and
    ``0 <= right_day - left_day <= max_days``, with the difference as ``dd``.

    ``keys`` must be named alike on both sides.  The output stays
    hash-partitioned on ``keys`` plus the left bucket (``_bucket``), so a
    grouping that contains them needs no further shuffle.
    """
    if bucket_days < max_days or bucket_days < 1:
        raise ValueError("bucket_days must be >= max_days")
    lb = left.withColumn("_bucket", _bucket(F.col(left_day), bucket_days))
    here = _bucket(F.col(right_day), bucket_days)
    prev = _bucket(F.date_sub(F.col(right_day), max_days), bucket_days)
    rb = right.withColumn("_bucket", F.explode(F.array_distinct(F.array(here, prev))))
    joined = lb.join(rb, [*keys, "_bucket"], "inner")
    dd = day_diff(F.col(right_day), F.col(left_day))
    return joined.withColumn("dd", dd).filter(F.col("dd").between(0, max_days))


def visit_window_stats(visits: DataFrame, daily: DataFrame, params: Params = Params()) -> DataFrame:
    """Per visit key (member_key, store_id, event_dt), for each window w:

    * ``n_w``: distinct (member text, first-order flag) pairs among effective
      order days in the window (the source query's row count per
      participation after its conversion join),
    * ``amt_w``: net amount of all order days in the window (NULL if none),
    * ``ord_w``: effective orders in the window,
    * ``hi_w`` / ``lo_w``: max / min first-order flag of effective days.

    ``visits`` are distinct keys without NULLs.  Only keys with at least one
    order day in the largest window appear.
    """
    windows = params.windows
    keys = visits.select(*VISIT_KEYS)
    right = daily.select(
        "member_key",
        F.col("lego_store_code").alias("store_id"),
        "order_day",
        "crm_member_id",
        "order_rrp_amt",
        "has_eff_order",
        "trans_cnt",
        "initial_purchase",
    )
    pairs = window_join(keys, right, ["member_key", "store_id"], "event_dt", "order_day",
                        params.max_window, params.bucket_days)

    inner, outer = {}, {}
    for w in windows:
        inw, eff = f"dd <= {w}", f"dd <= {w} AND has_eff_order"
        inner.update({
            f"amt_{w}": f"sum(CASE WHEN {inw} THEN order_rrp_amt END)",
            f"ord_{w}": f"sum(CASE WHEN {eff} THEN trans_cnt END)",
            f"hi_{w}": f"max(CASE WHEN {eff} THEN initial_purchase END)",
            f"lo_{w}": f"min(CASE WHEN {eff} THEN initial_purchase END)",
        })
        # The distinct first-order flags a member text variant has in the
        # window are {hi, lo}: their number is 0, 1 or 2, no DISTINCT needed.
        outer.update({
            f"n_{w}": f"sum(CASE WHEN hi_{w} IS NULL THEN 0 WHEN hi_{w} = lo_{w} THEN 1 ELSE 2 END)",
            f"amt_{w}": f"sum(amt_{w})",
            f"ord_{w}": f"sum(ord_{w})",
            f"hi_{w}": f"max(hi_{w})",
            f"lo_{w}": f"min(lo_{w})",
        })
    # Step 1 per member text variant, step 2 per visit key; both group by a
    # superset of the join's partitioning keys, so neither shuffles.
    per_variant = pairs.groupBy("member_key", "store_id", "_bucket", "event_dt", "crm_member_id").agg(*cols(inner))
    return per_variant.groupBy("member_key", "store_id", "_bucket", "event_dt").agg(*cols(outer)).drop("_bucket")


def with_window_stats(groups: DataFrame, stats: DataFrame) -> DataFrame:
    """Left-join the visit statistics to participation rows (rows without an
    order in the largest window get NULL statistics)."""
    return groups.join(stats, list(VISIT_KEYS), "left")


def conversion_columns(w: int, mult: str, params: Params) -> dict[str, Column]:
    """Window-``w`` contribution of one participation group, in the terms of
    the source query's conversion relation summed per group:

    * ``converted_{w}``: 1 if the member converted,
    * ``rrp_amt_{w}``: sum of the amount over the group's conversion rows
      (parity: ``n_w`` rows each carry the whole window amount; clean: once),
    * ``order_cnt_{w}``: sum of the order count (parity: every one of the
      ``mult`` participation rows repeats the window's orders; clean: once),
    * ``initial_{w}`` / ``repurchase_{w}``: converted with a first-order /
      a repeat-order day.
    """
    conv = f"coalesce(n_{w}, 0) > 0"
    amount = f"amt_{w} * n_{w}" if params.parity else f"amt_{w}"
    orders = f"ord_{w} * {mult}" if params.parity else f"ord_{w}"
    exprs = {
        f"converted_{w}": f"CASE WHEN {conv} THEN 1 ELSE 0 END",
        f"rrp_amt_{w}": f"CASE WHEN {conv} THEN {amount} ELSE 0 END",
        f"order_cnt_{w}": f"CAST(CASE WHEN {conv} THEN {orders} ELSE 0 END AS BIGINT)",
        f"initial_{w}": f"CASE WHEN {conv} AND hi_{w} = 1 THEN 1 ELSE 0 END",
        f"repurchase_{w}": f"CASE WHEN {conv} AND lo_{w} = 0 THEN 1 ELSE 0 END",
    }
    return dict(zip(exprs, cols(exprs)))
