"""Reservation counter (OP-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import Params
from .bitmaps import counted, member_bitmaps

RESERVATION_KEYS = ("campaign_code", "partner", "store_id", "event_id")


def count_reservations(reservation: DataFrame, params: Params = Params()) -> DataFrame:
    """Distinct members with a live advance reservation per campaign, agent,
    store and event.

    Cancelled rows and walk-ins are left out; a NULL status counts as
    cancelled.  The distinct count runs in two steps: first distinct
    (keys, member) pairs, shuffled on all five columns, then a plain count
    with map-side partial aggregation.  So one event holding a large share of
    all members is spread over many tasks instead of one.
    """
    live = reservation.filter(
        (F.col("res_status") != params.cancelled_status)
        & (F.col("source_type") == params.source_reserved)
    )
    named = live.select(
        "campaign_code",
        F.col("agent_id").alias("partner"),
        F.col("store_code").alias("store_id"),
        "event_id",
        "type_value",
    )
    if params.distinct == "bitmap":
        return counted(member_bitmaps(named, RESERVATION_KEYS, "type_value", {"ttl_reservations": "true"}), RESERVATION_KEYS, ["ttl_reservations"])
    pairs = named.distinct()
    return pairs.groupBy(*RESERVATION_KEYS).agg(F.count("type_value").alias("ttl_reservations"))
