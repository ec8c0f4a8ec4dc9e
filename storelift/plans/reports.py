"""The two report jobs (OP-13, OP-14) as single DataFrame plans."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expr import day_of
from ..functions.memberfilter import filter_words, may_be_member, member_filter
from ..operators.assemble import assemble_main, assemble_sibling
from ..operators.attribution import visit_window_stats, with_window_stats
from ..operators.metrics import BASE_KEYS, participation_groups, participation_metrics, same_day_report, window_report
from ..operators.participations import main_stores, participation_rows, visit_keys
from ..operators.reservations import count_reservations
from ..operators.rollups import at_stores, daily_activity
from ..operators.sweep import visit_window_sweep
from ..params import Params
from ..session import stored
from ..sources.schemas import SCHEMAS
from ..sources.tables import Sources


@dataclasses.dataclass(frozen=True)
class Prepared:
    """The reservations as the reports read them, and what is known of them.

    ``visits`` are the distinct (member_key, store_id, event_dt) that orders are
    attributed to, ``visitors`` about how many members they name.
    """

    src: Sources
    days: tuple
    visits: DataFrame
    visitors: int


def prepare(src: Sources, params: Params = Params()) -> Prepared:
    """Read the reservation fact once.

    One pass writes the columns and rows that any part of the reports uses
    (verified reservations and live advance reservations) to the shared folder; an
    ``Observation`` of that pass gives the first and last verified event day.
    From the stored rows come the visit keys, stored too, with their number
    of members observed on the way.  Only these three values reach the driver.
    """
    reservation = src.campaign_reservation
    verified = F.col("res_status") == params.verified_status
    live = (F.col("res_status") != params.cancelled_status) & (F.col("source_type") == params.source_reserved)
    names = [f.name for f in SCHEMAS["campaign_reservation"].fields]
    day = F.when(verified, day_of("verification_time"))
    seen = Observation("reservations")
    rows = stored(reservation.select(*names).where(verified | live)
                             .observe(seen, F.min(day).alias("first"), F.max(day).alias("last")), "reservations")
    narrow = dataclasses.replace(src, campaign_reservation=rows)
    members = Observation("visits")
    visits = stored(visit_keys(narrow, params).observe(members, F.approx_count_distinct("member_key").alias("members")), "visit-keys")
    return Prepared(narrow, (seen.get["first"], seen.get["last"]), visits, members.get["members"])


def attributable_orders(src: Sources, params: Params, days: tuple) -> DataFrame:
    """The order lines the attribution can use.

    With ``prune_order_days`` only lines dated from the first verified event
    day to the last one plus the largest window are read: the bound becomes
    a filter on ``date_id`` that Spark pushes into the scan.  Lines outside
    can match no visit, so the result is unchanged.
    """
    orders = src.member_order_detail
    if not params.prune_order_days:
        return orders
    lo, hi = days
    if lo is None:
        return orders.filter(F.lit(False))
    hi = hi + dt.timedelta(days=params.max_window)
    if dict(orders.dtypes).get("date_id") == "date":
        # Plain column comparison: pushed to the scan.
        return orders.filter(F.col("date_id").between(F.lit(lo), F.lit(hi)))
    day = day_of("date_id", params.order_date_format).between(F.lit(lo), F.lit(hi))
    text_bounds = sortable_text(lo, hi, params.order_date_format)
    if text_bounds:
        # Text days in a sortable format: compare the text too, which reaches the scan.
        day = F.col("date_id").between(*map(F.lit, text_bounds)) & day
    return orders.filter(day)


def sortable_text(lo: dt.date, hi: dt.date, fmt: str | None) -> tuple[str, str] | None:
    """The bounds as text, if days in format ``fmt`` sort as their text does."""
    forms = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d"}
    return (lo.strftime(forms[fmt]), hi.strftime(forms[fmt])) if fmt in forms else None


def visitors_orders(prepared: Prepared, params: Params = Params()) -> DataFrame:
    """The order lines of visiting members at the selected stores, by day bound,
    store semi-join and member filter: all before the first exchange."""
    orders = attributable_orders(prepared.src, params, prepared.days)
    orders = at_stores(orders, main_stores(prepared.src, params), params)
    words = filter_words(prepared.visitors, params.member_filter_max_bits)
    if not words:
        return orders
    return orders.where(may_be_member(member_filter(prepared.visits, "member_key", words), orders["crm_member_id"].try_cast("int"), words))


def attributed_groups(src: Sources, params: Params = Params(), prepared: Prepared | None = None) -> DataFrame:
    """Same-day participation groups of the main table with their visit's
    window statistics: the shared input of every conversion metric.

    The visits that orders are attributed to come straight from the
    reservations, so members and coupons are joined once, for the groups.
    """
    prepared = prepared or prepare(src, params)
    groups = participation_groups(participation_rows(prepared.src, params, "main"))
    daily = daily_activity(visitors_orders(prepared, params), params)
    stats = visit_window_stats if params.attribution == "join" else visit_window_sweep
    return with_window_stats(groups, stats(prepared.visits, daily, params))


def campaign_performance(src: Sources, params: Params = Params(), prepared: Prepared | None = None) -> DataFrame:
    """The 82-column campaign performance table, one row per campaign, agent,
    store and event day (repeated as the source query repeats it)."""
    if tuple(params.windows) != (0, 7, 30):
        raise ValueError("the 82-column table is defined for windows (0, 7, 30)")
    prepared = prepared or prepare(src, params)
    groups = attributed_groups(src, params, prepared)
    if params.store_groups:
        # The same-day and the longer-window tables read these rows but prune
        # different columns, which would stop Spark from reusing one
        # computation for both.
        groups = stored(groups, "attributed-groups")
    base0 = same_day_report(groups, params, 0)
    later = window_report(groups, params, (7, 30))
    if params.store_groups:
        # At report grain; the two window joins read their own columns of it.
        later = stored(later, "window-report")
    return assemble_main(base0, count_reservations(prepared.src.campaign_reservation, params), {7: later, 30: later}, params)


def in_store_activity(src: Sources, params: Params = Params(), prepared: Prepared | None = None) -> DataFrame:
    """The 18-column in-store activity table of the sibling distributor.

    Alone it reads the reservations twice; with ``prepared`` it reads the
    stored ones."""
    src = prepared.src if prepared else src
    rows = participation_rows(src, params, "sibling")
    base = participation_metrics(rows, BASE_KEYS, with_coupon=False, params=params)
    return assemble_sibling(base, count_reservations(src.campaign_reservation, params))
