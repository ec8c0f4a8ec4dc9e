"""Star enrichment of verified participations (OP-2), the new/existing member
tag (OP-3) and the recruitment-coupon flag (OP-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.broadcast import broadcast_if_small
from ..functions.expr import day_of, flag, member_key
from ..params import Params
from ..sources.tables import Sources

# Columns of the participation relation, in order (the main table adds
# redeemed_coupon; the sibling has no coupon).
PARTICIPATION_COLUMNS = (
    "campaign_code", "campaign_type", "campaign_name", "agent_id", "distributor", "region",
    "partner", "city", "store_id", "store_name", "event_id", "event_dt", "source_type",
    "member_id", "res_status", "join_time", "new_member_tag",
)
MAIN_PARTICIPATION_COLUMNS = PARTICIPATION_COLUMNS + ("redeemed_coupon",)


def main_distributor(params: Params) -> Column:
    """Main table: distributors whose name contains the LCS marker."""
    return F.col("distributor").like(params.main_distributor_like)


def sibling_distributor(params: Params) -> Column:
    return F.col("distributor") == params.sibling_distributor


def verified_visits(src: Sources, params: Params, distributor: Column) -> DataFrame:
    """Verified reservations of listed campaigns at the selected distributor's
    stores, with store and campaign attributes, de-duplicated.

    The campaign lookup and the store dimensions are broadcast when their
    estimated bytes are small; the LEFT JOINs of the source query followed by
    ``IS NOT NULL`` / ``LIKE`` filters on their columns are inner joins.  The
    de-duplication (map-side partial first) shrinks repeated check-ins before
    the member and coupon joins.
    """
    campaigns, stores, app = [broadcast_if_small(d, params.broadcast_max_bytes) for d in (
        src.campaign_code.select("campaign_code", "campaign_type"),
        src.phy_store.filter(distributor)
        .select(F.col("lego_store_code").alias("store_code"), "distributor", "region", "partner"),
        src.app_store.select(
            F.col("store_id").alias("_app_store_id"), F.col("city_name").alias("city"),
            F.col("name").alias("store_name"),
        ),
    )]
    rev = src.campaign_reservation.filter(F.col("res_status") == params.verified_status)
    joined = (
        rev.join(campaigns, "campaign_code", "inner")
        .join(stores, "store_code", "inner")
        .join(app, rev.store_id == app._app_store_id, "left")
    )
    return joined.select(
        "campaign_code", "campaign_type", "campaign_name", "agent_id", "distributor", "region",
        "partner", "city",
        F.col("store_code").alias("store_id"),
        "store_name", "event_id",
        day_of("verification_time").alias("event_dt"),
        "source_type",
        F.col("type_value").alias("member_id"),
        "res_status",
    ).distinct().withColumn("member_key", visit_member_key(params))


def visit_member_key(params: Params) -> Column:
    """Integer member id of a visit as a long.

    Visits without one (NULL or, with ``on_bad_id="null"``, malformed ids) get
    a number beyond the integers instead, spread by visit attributes: it
    matches no member, coupon or order, and such visits do not meet in one
    partition of the joins.  The attributes are part of every grouping, so a
    group's rows share one number.
    """
    spread = F.pmod(F.xxhash64("member_id", "campaign_code", "store_id", "event_id", "event_dt"), F.lit(1 << 40))
    return F.coalesce(member_key("member_id", params).cast("long"), spread + F.lit(1 << 40))


def member_rows(members: DataFrame, params: Params) -> DataFrame:
    """The source's DISTINCT member sub-select with its integer id; rows
    without an id are left out (they match no visit)."""
    return members.select(
        member_key("member_detail_id", params).cast("long").alias("_mbr_key"), "join_time", "eff_reg_store",
    ).where("_mbr_key IS NOT NULL").distinct()


def new_member_tag(df: DataFrame) -> DataFrame:
    """The tag of each (visit, member row): 1 when the member joined on the event day at the
    event store (``eff_reg_store``), else 0 (also when the member is
    unknown)."""
    return df.withColumn(
        "new_member_tag",
        flag((day_of("join_time") == F.col("event_dt")) & (F.col("store_id") == F.col("eff_reg_store"))),
    )


def coupon_keys(coupons: DataFrame, params: Params) -> DataFrame:
    """Distinct (member, redemption day, store) of redeemed recruitment coupons."""
    return (
        coupons.filter(
            (F.col("coupon_code") == params.coupon_code)
            & (F.col("coupon_status_code") == params.coupon_status)
        )
        .select(
            member_key("member_detail_id", params).cast("long").alias("_cp_member"),
            day_of("redeemed_time").alias("_cp_day"),
            F.col("redeemed_channel_code").alias("_cp_store"),
        )
        .where("_cp_member IS NOT NULL")
        .distinct()
    )


def flag_redemption(df: DataFrame, coupons: DataFrame, params: Params = Params()) -> DataFrame:
    """Add ``redeemed_coupon``: 1 when the member redeemed the recruitment
    coupon at the event store on the event day and the campaign type is the
    coupon's type.

    The type test belongs to the join condition, not to a filter: rows of
    other campaign types stay, unflagged.  The right side is distinct on the
    join keys, so the left join cannot repeat rows.
    """
    keys = coupon_keys(coupons, params)
    hit = (
        (df.member_key == keys._cp_member)
        & (df.event_dt == keys._cp_day)
        & (df.store_id == keys._cp_store)
    )
    out = df.join(keys, hit, "left")
    return out.withColumn(
        "redeemed_coupon",
        flag(F.col("_cp_member").isNotNull() & (F.col("campaign_type") == params.coupon_campaign_type)),
    ).drop("_cp_member", "_cp_day", "_cp_store")


def _with_members(visits: DataFrame, src: Sources, params: Params) -> DataFrame:
    """Visits beside their member rows, tagged, with repeats removed.

    The repeats (member rows that differ in their store only) go in a grouping
    that contains the join key, so after a shuffle join it needs no exchange.
    """
    mbr = member_rows(src.member_detail, params)
    tagged = new_member_tag(visits.join(mbr, visits.member_key == mbr._mbr_key, "left"))
    return tagged.drop("_mbr_key", "eff_reg_store").distinct()


def participation_rows(src: Sources, params: Params = Params(), scope: str = "main") -> DataFrame:
    """Distinct participation rows plus the long ``member_key``."""
    if scope == "main":
        visits = verified_visits(src, params, main_distributor(params))
        out = flag_redemption(_with_members(visits, src, params), src.coupon_benefit, params)
        cols = MAIN_PARTICIPATION_COLUMNS
    elif scope == "sibling":
        visits = verified_visits(src, params, sibling_distributor(params))
        out = _with_members(visits, src, params)
        cols = PARTICIPATION_COLUMNS
    else:
        raise ValueError("scope must be 'main' or 'sibling'")
    return out.select(*cols, "member_key")


def visit_keys(src: Sources, params: Params = Params()) -> DataFrame:
    """Distinct (member_key, store_id, event_dt) of the main table's visits,
    straight from the reservations: listed campaigns and selected stores are
    semi-joins, and no member is joined."""
    campaigns = src.campaign_code.select("campaign_code")
    return (
        src.campaign_reservation.filter(F.col("res_status") == params.verified_status)
        .join(broadcast_if_small(campaigns, params.broadcast_max_bytes), "campaign_code", "left_semi")
        .join(broadcast_if_small(main_stores(src, params), params.broadcast_max_bytes), "store_code", "left_semi")
        .select(member_key("type_value", params).cast("long").alias("member_key"),
                F.col("store_code").alias("store_id"), day_of("verification_time").alias("event_dt"))
        .where("member_key IS NOT NULL AND event_dt IS NOT NULL")
        .distinct()
    )


def main_stores(src: Sources, params: Params) -> DataFrame:
    """Codes of the main table's stores."""
    return src.phy_store.filter(main_distributor(params)).select(F.col("lego_store_code").alias("store_code"))


def participations(src: Sources, params: Params = Params(), scope: str = "main") -> DataFrame:
    """Verified participations: one row per distinct combination of campaign,
    agent, store attributes, event, day, source, member, status, join time,
    new-member tag (and, for the main table, coupon flag)."""
    return participation_rows(src, params, scope).drop("member_key")
