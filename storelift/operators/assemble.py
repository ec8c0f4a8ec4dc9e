"""Wide assembly of the report tables (OP-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import batch_date, label, load_time
from ..params import Params
from ..functions.sqlexpr import cols
from .metrics import SEGMENTS, conversion_metric_columns, cr_name, kpi_columns

# The published column names and their order.
DIMENSION_COLUMNS = (
    "campaign_type", "agent_id", "partner", "distributor", "city", "region", "store_id", "store_name",
    "store_id_store_name", "campaign_code", "campaign_name", "date_id",
)
PARTICIPANT_COLUMNS = (
    "ttl_reservations", "ttl_reservation_participants", "ttl_walkin_participants", "ttl_participants",
)


def _window_block(w: int) -> list[str]:
    """Output order of one window's 20 columns."""
    return (
        [f"converted_{s}member_{w}_days" for s in SEGMENTS]
        + [cr_name(w, s) for s in SEGMENTS]
        + [f"converted_rrp_amt_{s}{w}_days" for s in SEGMENTS]
        + [f"converted_{s}member_aspp_{w}_days" for s in SEGMENTS]
        + [f"converted_order_cnt_{s}{w}_days" for s in SEGMENTS]
        + [f"converted_{s}member_atv_{w}_days" for s in SEGMENTS]
        + [f"converted_initial_member_{w}_days", f"converted_repurchase_member_{w}_days"]
    )


MAIN_COLUMNS = (
    DIMENSION_COLUMNS
    + ("ttl_invitation",)
    + PARTICIPANT_COLUMNS
    + ("ttl_redeemed_recruitment_bags", "new_participants", "existing_participants")
    + tuple(_window_block(0)) + tuple(_window_block(7)) + tuple(_window_block(30))
    + ("dl_batch_date", "dl_load_time")
)
SIBLING_COLUMNS = DIMENSION_COLUMNS + PARTICIPANT_COLUMNS + ("new_participants", "existing_participants")

assert len(MAIN_COLUMNS) == 82 and len(SIBLING_COLUMNS) == 18


def with_reservations(base: DataFrame, reservations: DataFrame) -> DataFrame:
    """Left join of the reservation counts on campaign, store and event.  The
    counts are per agent, so several agents repeat the row, and they carry no
    day, so every day of the event gets the same count."""
    res = reservations.select("campaign_code", "store_id", "event_id", "ttl_reservations")
    return base.join(res, ["campaign_code", "store_id", "event_id"], "left")


def assemble_sibling(base: DataFrame, reservations: DataFrame) -> DataFrame:
    out = with_reservations(base, reservations).withColumn("store_id_store_name", label("store_id", "store_name"))
    return out.select(*SIBLING_COLUMNS)


def assemble_main(base0: DataFrame, reservations: DataFrame, window_bases: dict[int, DataFrame],
                  params: Params = Params()) -> DataFrame:
    """base_0 + reservation counts + one left join per longer window on
    (store, campaign, event, day).

    Each window table has finer keys than the join (campaign type, partner,
    city and store name are keys but are not joined on), so one report row
    can meet several window rows, and the two joins give the product of both,
    as in the source.  Both windows may come from one table; each join reads
    its own columns of it.
    """
    out = with_reservations(base0, reservations)
    join_keys = ["store_id", "campaign_code", "event_id", "date_id"]
    for w, table in sorted(window_bases.items()):
        right = table.select(*join_keys, *conversion_metric_columns(w))
        out = out.join(right, join_keys, "left")
    # One projection: ratios of every window (from the joined counts, so the
    # 7/30-day rates divide by this row's participants), label, stamps, order.
    derived = {}
    for w in (0, *sorted(window_bases)):
        derived.update(dict(zip(kpi_columns(w), cols(kpi_columns(w)))))
    derived.update({
        "store_id_store_name": label("store_id", "store_name"),
        "ttl_invitation": F.lit(0),
        "dl_batch_date": batch_date(params),
        "dl_load_time": load_time(params),
    })
    return out.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in MAIN_COLUMNS])
