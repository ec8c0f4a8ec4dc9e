"""Segmented participation and conversion metrics (OP-8, OP-9) and KPI
ratios (OP-10).

Distinct member counts are computed in two aggregation steps, never with
``COUNT(DISTINCT ...)`` over many predicates (which Catalyst expands into one
row copy per distinct expression): first one row per (report keys, member)
with 0/1 flags, then sums of the flags per report key.  Both steps use
map-side partial aggregation, so a report key holding a large share of all
members is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqlexpr import cols, q, sql_flag, sql_ratio, sums
from ..params import Params
from .attribution import VISIT_KEYS, conversion_columns
from .bitmaps import counted, member_bitmaps

# Report keys of the per-event-day table (the source's base_0 grain; the
# label column store_id_store_name is derived from two of them).
BASE_KEYS = (
    "campaign_type", "agent_id", "distributor", "region", "partner", "city", "store_id",
    "store_name", "campaign_code", "campaign_name", "event_id", "date_id",
)
# Report keys of the 7/30-day tables (the source's base_7 / base_30 grain).
WINDOW_KEYS = ("campaign_type", "partner", "city", "store_id", "store_name", "campaign_code", "event_id", "date_id")

# Conversion grain of the same-day window: the participation columns kept by
# the source's conversion join (join time and status are dropped).
GROUP_KEYS_0 = (
    "agent_id", "distributor", "region", "partner", "city", "store_id", "store_name", "event_id",
    "event_dt", "source_type", "member_id", "campaign_code", "campaign_type", "new_member_tag",
    "redeemed_coupon", "campaign_name",
)
# Conversion grain of the 7/30-day windows (no coupon flag, no campaign name).
GROUP_KEYS_W = tuple(k for k in GROUP_KEYS_0 if k not in ("redeemed_coupon", "campaign_name"))

SEGMENTS = ("", "new_", "existing_")

PARTICIPANT_COUNTS = (
    ("ttl_reservation_participants", "f_sched"),
    ("ttl_walkin_participants", "f_walk"),
    ("ttl_participants", "f_part"),
    ("new_participants", "f_new"),
    ("existing_participants", "f_ex"),
)
KNOWN = "member_id IS NOT NULL"


def participation_groups(rows: DataFrame, keys: Sequence[str] = GROUP_KEYS_0) -> DataFrame:
    """Distinct participation groups with ``mult``: how many distinct
    participation rows (differing only in join time) each group stands for.
    The rows are distinct already, so this is a plain count with map-side
    partial aggregation.
    """
    return rows.groupBy(*keys, "member_key").agg(F.count(F.lit(1)).alias("mult"))


def _participant_conditions(params: Params, with_coupon: bool) -> dict[str, str]:
    out = {
        "f_sched": f"{KNOWN} AND source_type = {params.source_reserved}",
        "f_walk": f"{KNOWN} AND source_type = {params.source_walk_in}",
        "f_part": KNOWN,
        "f_new": f"{KNOWN} AND new_member_tag = 1",
        "f_ex": f"{KNOWN} AND new_member_tag = 0",
    }
    if with_coupon:
        out["f_red"] = f"{KNOWN} AND redeemed_coupon = 1"
    return out


def _participant_flags(params: Params, with_coupon: bool) -> dict[str, str]:
    return {name: f"max({sql_flag(cond)})" for name, cond in _participant_conditions(params, with_coupon).items()}


def participation_metrics(rows: DataFrame, keys: Sequence[str] = BASE_KEYS, with_coupon: bool = False,
                          params: Params = Params()) -> DataFrame:
    """Distinct members per report key: reserved and attended, walk-in, all,
    new, existing (and coupon redeemers).  ``rows`` are participation rows
    with ``event_dt``; duplicates do not matter."""
    src = rows.withColumnRenamed("event_dt", "date_id") if "event_dt" in rows.columns else rows
    counts = list(PARTICIPANT_COUNTS)
    if with_coupon:
        counts.append(("ttl_redeemed_recruitment_bags", "f_red"))
    if params.distinct == "bitmap":
        conditions = _participant_conditions(params, with_coupon)
        names = [name for name, _ in counts]
        return counted(member_bitmaps(src, keys, "member_id", {name: conditions[f] for name, f in counts}), keys, names)
    per_member = src.groupBy(*keys, "member_id").agg(*cols(_participant_flags(params, with_coupon)))
    return per_member.groupBy(*keys).agg(*cols({name: f"sum({f})" for name, f in counts}))


def _segment_amount(amount: str, g_seg: str, g_other: str) -> str:
    """Sum over a member's conversion rows of ``CASE WHEN converted AND in
    segment THEN amount ELSE 0 END``: ``g_seg`` groups carry the amount,
    ``g_other`` groups add zeros.  NULL only when every term is NULL."""
    return (f"CASE WHEN {amount} IS NULL THEN (CASE WHEN {g_other} > 0 THEN 0 END) "
            f"ELSE {amount} * {g_seg} END")


def _window_member_columns(w: int, params: Params) -> dict[str, str]:
    """Per (report keys, member) conversion columns of window ``w`` from the
    group counts g_new/g_ex, multiplicities m_new/m_ex, flags and the
    window statistics of the member's visit."""
    conv = f"coalesce(n_{w}, 0) > 0"
    known = f"({conv}) AND {KNOWN}"
    amt, ords = f"amt_{w}", f"ord_{w}"
    if params.parity:
        per_group = f"({amt} * n_{w})"
        seg_amt = {
            "": _segment_amount(per_group, "(g_new + g_ex)", "0"),
            "new_": _segment_amount(per_group, "g_new", "g_ex"),
            "existing_": _segment_amount(per_group, "g_ex", "g_new"),
        }
        seg_ord = {"": f"{ords} * (m_new + m_ex)", "new_": f"{ords} * m_new", "existing_": f"{ords} * m_ex"}
    else:
        seg_amt = {"": amt, "new_": f"CASE WHEN g_new > 0 THEN {amt} ELSE 0 END",
                   "existing_": f"CASE WHEN g_ex > 0 THEN {amt} ELSE 0 END"}
        seg_ord = {"": ords, "new_": f"CASE WHEN g_new > 0 THEN {ords} END",
                   "existing_": f"CASE WHEN g_ex > 0 THEN {ords} END"}
    out = {
        f"converted_member_{w}_days": sql_flag(known),
        f"converted_new_member_{w}_days": sql_flag(f"{known} AND g_new > 0"),
        f"converted_existing_member_{w}_days": sql_flag(f"{known} AND g_ex > 0"),
    }
    for seg in SEGMENTS:
        out[f"converted_rrp_amt_{seg}{w}_days"] = f"CASE WHEN {conv} THEN {seg_amt[seg]} ELSE 0 END"
    for seg in SEGMENTS:
        out[f"converted_order_cnt_{seg}{w}_days"] = (
            f"CAST(CASE WHEN {conv} THEN coalesce({seg_ord[seg]}, 0) ELSE 0 END AS BIGINT)")
    out[f"converted_initial_member_{w}_days"] = sql_flag(f"{known} AND hi_{w} = 1")
    out[f"converted_repurchase_member_{w}_days"] = sql_flag(f"{known} AND lo_{w} = 0")
    return out


def conversion_count_columns(w: int) -> list[str]:
    return [f"converted_{s}member_{w}_days" for s in SEGMENTS]


def conversion_sum_columns(w: int) -> tuple[list[str], list[str]]:
    return ([f"converted_rrp_amt_{s}{w}_days" for s in SEGMENTS],
            [f"converted_order_cnt_{s}{w}_days" for s in SEGMENTS])


def conversion_metric_columns(w: int) -> list[str]:
    amounts, orders = conversion_sum_columns(w)
    return (conversion_count_columns(w) + amounts + orders
            + [f"converted_initial_member_{w}_days", f"converted_repurchase_member_{w}_days"])


def _stat_aggs(windows: Sequence[int]) -> dict[str, str]:
    # The statistics depend only on the visit key, which every grouping
    # below contains; max() just carries the one value through.
    return {f"{s}_{w}": f"max({s}_{w})" for w in windows for s in ("n", "amt", "ord", "hi", "lo")}


def _group_counts(mult: str) -> dict[str, str]:
    return {
        "g_new": "sum(CASE WHEN new_member_tag = 1 THEN 1 ELSE 0 END)",
        "g_ex": "sum(CASE WHEN new_member_tag = 0 THEN 1 ELSE 0 END)",
        "m_new": f"sum(CASE WHEN new_member_tag = 1 THEN {mult} ELSE 0 END)",
        "m_ex": f"sum(CASE WHEN new_member_tag = 0 THEN {mult} ELSE 0 END)",
    }


def _report_totals(per_member: DataFrame, keys: Sequence[str], windows: Sequence[int],
                   extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    aggs = {name: f"sum({src})" for name, src in extra}
    for w in windows:
        amounts, orders = conversion_sum_columns(w)
        aggs.update(sums(conversion_count_columns(w)))
        aggs.update(sums(amounts, "DECIMAL(18,2)"))
        aggs.update(sums(orders))
        aggs.update(sums([f"converted_initial_member_{w}_days", f"converted_repurchase_member_{w}_days"]))
    return per_member.groupBy(*keys).agg(*cols(aggs))


def same_day_report(groups: DataFrame, params: Params = Params(), w: int = 0) -> DataFrame:
    """The per-event-day table (the source's base_0, without ratios): the
    participant counts and the window-``w`` conversion metrics per report
    key.  ``groups`` are ``participation_groups`` rows joined to the visit
    statistics."""
    g = groups.withColumnRenamed("event_dt", "date_id")
    aggs = {**_group_counts("mult"), **_participant_flags(params, True), **_stat_aggs([w])}
    per_member = g.groupBy(*BASE_KEYS, "member_id").agg(*cols(aggs))
    per_member = per_member.select("*", *cols(_window_member_columns(w, params)))
    counts = list(PARTICIPANT_COUNTS) + [("ttl_redeemed_recruitment_bags", "f_red")]
    return _report_totals(per_member, BASE_KEYS, [w], counts)


def window_report(groups: DataFrame, params: Params = Params(), windows: Sequence[int] = (7, 30)) -> DataFrame:
    """The 7/30-day tables (the source's base_7 and base_30, which share their
    keys and rows) in one aggregation, without ratios."""
    g = groups.withColumnRenamed("event_dt", "date_id")
    gw = [k if k != "event_dt" else "date_id" for k in GROUP_KEYS_W]
    # Conversion groups of the longer windows: sum the multiplicities of the
    # same-day groups they merge.
    coarse = g.groupBy(*gw, "member_key").agg(*cols({"mult": "sum(mult)", **_stat_aggs(windows)}))
    per_member = coarse.groupBy(*WINDOW_KEYS, "member_id").agg(
        *cols({**_group_counts("mult"), **_stat_aggs(windows)}))
    derived = {}
    for w in windows:
        derived.update(_window_member_columns(w, params))
    per_member = per_member.select("*", *cols(derived))
    return _report_totals(per_member, WINDOW_KEYS, windows)


def cr_name(w: int, seg: str) -> str:
    # Fixed output names: the same-day rate is singular ("CR_0_day").
    suffix = "day" if w == 0 else "days"
    return f"{seg}member_CR_{w}_{suffix}" if seg else f"CR_{w}_{suffix}"


def kpi_columns(w: int, participants: dict[str, str] | None = None) -> dict[str, str]:
    participants = participants or {"": "ttl_participants", "new_": "new_participants",
                                    "existing_": "existing_participants"}
    out = {}
    for seg in SEGMENTS:
        out[cr_name(w, seg)] = sql_ratio(q(f"converted_{seg}member_{w}_days"), q(participants[seg]))
    for seg in SEGMENTS:
        out[f"converted_{seg}member_aspp_{w}_days"] = sql_ratio(
            q(f"converted_rrp_amt_{seg}{w}_days"), q(f"converted_{seg}member_{w}_days"))
    for seg in SEGMENTS:
        out[f"converted_{seg}member_atv_{w}_days"] = sql_ratio(
            q(f"converted_rrp_amt_{seg}{w}_days"), q(f"converted_order_cnt_{seg}{w}_days"))
    return out


def kpi_ratios(df: DataFrame, w: int, participants: dict[str, str] | None = None) -> DataFrame:
    """Conversion rate, spend per converted member (aspp) and value per
    order (atv) of window ``w`` for all / new / existing members.  Division
    by zero gives NULL."""
    return df.select("*", *cols(kpi_columns(w, participants)))


__all__ = [
    "BASE_KEYS", "WINDOW_KEYS", "GROUP_KEYS_0", "GROUP_KEYS_W", "VISIT_KEYS", "conversion_columns",
    "participation_groups", "participation_metrics", "same_day_report", "window_report", "kpi_ratios",
    "kpi_columns", "conversion_metric_columns", "cr_name",
]
