"""Incremental refresh of the campaign performance table.

An event day's conversions depend on its own visits, on the order lines from it
to the largest window later, on the coupons redeemed that day, on the member rows
of its visitors and on the lookups.  Days whose inputs have not changed since the
last run keep their rows: an event day older than the largest window is final
unless a line, a visit or a member is corrected.

A run

1. takes fingerprints (row count and sum of row hashes) of the inputs: visits,
   order lines and coupons by day, member rows by member, lookups as a whole.  This
   reads the facts once, narrow, and shuffles only one row a day and task;
2. compares them with those of the last run: changed days and members give the
   event days to compute again, a changed lookup or parameter gives all of them;
3. runs attribution and metrics for those days alone, from the order lines of
   their windows, and stores the day's report rows (same-day and longer windows);
4. joins all days' report rows with the reservation counts, which know no day.

The state is a folder: ``runs/<run>`` holds the rows of the days that run computed
and its fingerprints, ``manifests/<number>`` names the run of every day.  Writing
the manifest commits the run; what a run that died has left is removed by the
next.  When days are spread over ``MAX_RUNS`` runs they are written together.
The driver holds a few values for each calendar day, never rows or members.

One run at a time may work on a state folder.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import logging
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import day_of
from ..operators.assemble import assemble_main
from ..operators.metrics import same_day_report, window_report
from ..operators.participations import coupon_keys, main_stores, member_rows
from ..operators.reservations import count_reservations
from ..operators.rollups import at_stores, attributable_lines
from ..params import Params
from ..session import drop_path, stored
from ..sinks.files import names, read_text, write_text
from ..sources.schemas import SCHEMAS
from ..sources.tables import Sources
from .reports import Prepared, attributable_orders, attributed_groups, prepare

MAX_RUNS = 16
#: Stands for visits without a day among the stored days.
NO_DAY = dt.date(1600, 1, 1)

log = logging.getLogger(__name__)


@dataclasses.dataclass(frozen=True)
class Touched:
    """What a run computed: event days again, days that are gone, and of how many."""

    days: tuple[dt.date, ...]
    gone: tuple[dt.date, ...]
    total: int
    reasons: dict[str, int]


@dataclasses.dataclass(frozen=True)
class State:
    """The manifest of the last committed run."""

    number: int
    run: str
    settings: str
    lookups: str
    days: dict[dt.date, str]


def _hash_sum(columns: Iterable[str]) -> Column:
    """The exact sum of the row hashes.

    Summed as longs, in three pieces of at most 22 bits (enough for 2^41 rows):
    a decimal sum takes several times as long a row."""
    h = F.xxhash64(*columns)
    low = lambda x: x.bitwiseAND(F.lit((1 << 22) - 1))
    pieces = [F.sum(p).cast("decimal(20,0)") for p in (F.shiftright(h, 44), low(F.shiftright(h, 22)), low(h))]
    return pieces[0] * F.lit(1 << 44) + pieces[1] * F.lit(1 << 22) + pieces[2]


def _fingerprint(df: DataFrame, kind: str, day: Column, columns: list[str]) -> DataFrame:
    """(kind, day, fingerprint) for each day of ``df``; equal for equal bags of rows."""
    return (df.groupBy(F.coalesce(day, F.lit(NO_DAY)).alias("day")).agg(F.count(F.lit(1)).alias("n"), _hash_sum(columns).alias("h"))
              .select(F.lit(kind).alias("kind"), "day", F.concat_ws(":", "n", "h").alias("fingerprint")))


def day_fingerprints(prepared: Prepared, params: Params) -> DataFrame:
    """(kind, day, fingerprint) of visits, order lines and coupons."""
    src = prepared.src
    reservations = src.campaign_reservation.where(F.col("res_status") == params.verified_status)
    lines = at_stores(attributable_lines(attributable_orders(src, params, prepared.days), params), main_stores(src, params), params)
    columns = lambda role: [f.name for f in SCHEMAS[role].fields]
    return (_fingerprint(reservations, "visits", day_of("verification_time"), columns("campaign_reservation"))
            .unionAll(_fingerprint(lines, "orders", day_of("date_id", params.order_date_format), columns("member_order_detail")))
            .unionAll(_fingerprint(coupon_keys(src.coupon_benefit, params), "coupons", F.col("_cp_day"), ["_cp_member", "_cp_day", "_cp_store"])))


def member_fingerprints(src: Sources, params: Params) -> DataFrame:
    """(member_key, fingerprint) of the member rows a visit may meet."""
    rows = member_rows(src.member_detail, params)
    return rows.groupBy(F.col("_mbr_key").alias("member_key")).agg(
        F.concat_ws(":", F.count(F.lit(1)), _hash_sum(["join_time", "eff_reg_store"])).alias("fingerprint"))


def lookup_fingerprint(src: Sources) -> str:
    """One text for the campaign and store lookups."""
    parts = []
    for role in ("campaign_code", "phy_store", "app_store"):
        columns = [f.name for f in SCHEMAS[role].fields]
        row = getattr(src, role).agg(F.count(F.lit(1)).alias("n"), _hash_sum(columns).alias("h")).first()
        parts.append(f"{row['n']}:{row['h']}")
    return " ".join(parts)


def _settings(params: Params) -> str:
    return repr(dataclasses.replace(params, batch_ts=None))


def load_state(spark: SparkSession, folder: str) -> State | None:
    numbers = [int(n) for n in names(spark, f"{folder}/manifests") if n.isdigit()]
    if not numbers:
        return None
    got = json.loads(read_text(spark, f"{folder}/manifests/{max(numbers)}"))
    return State(max(numbers), got["run"], got["settings"], got["lookups"], {dt.date.fromisoformat(d): r for d, r in got["days"].items()})


def _changed(before: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose fingerprint is new, gone or different."""
    old = before.withColumnRenamed("fingerprint", "_old")
    return now.join(old, keys, "full_outer").where("NOT (fingerprint <=> _old)").select(*keys)


def _windows(days: Iterable[dt.date], width: int) -> list[tuple[dt.date, dt.date]]:
    """The order days that the event days can use, as few ranges."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in sorted(days):
        if out and d <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], d + dt.timedelta(days=width))
        else:
            out.append((d, d + dt.timedelta(days=width)))
    return out


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _only(prepared: Prepared, days: list[dt.date], params: Params) -> Prepared:
    """``prepared`` cut to some event days and the order lines of their windows."""
    src, known = prepared.src, [d for d in days if d != NO_DAY]
    event = day_of("verification_time")
    wanted = event.isin(known) | (event.isNull() if NO_DAY in days else F.lit(False))
    orders = src.member_order_detail
    plain = dict(orders.dtypes).get("date_id") == "date"
    day = F.col("date_id") if plain else day_of("date_id", params.order_date_format)
    ranges = [day.between(F.lit(a), F.lit(b)) for a, b in _windows(known, params.max_window)]
    narrow = dataclasses.replace(src, campaign_reservation=src.campaign_reservation.where((F.col("res_status") == params.verified_status) & wanted),
                                 member_order_detail=orders.where(_any(ranges)))
    return Prepared(narrow, prepared.days, prepared.visits.where(F.col("event_dt").isin(known)), prepared.visitors)


def _touched(prepared: Prepared, params: Params, state: State | None, folder: str, run: str, lookups: str) -> Touched:
    """Compare the stored fingerprints of this run with those of the last."""
    spark = prepared.visits.sparkSession
    now = spark.read.parquet(f"{folder}/runs/{run}/days")
    event_days = {r["day"] for r in now.where("kind = 'visits'").select("day").collect()}
    if state is None or state.settings != _settings(params) or state.lookups != lookups:
        days = set(event_days)
        reasons = {"first run" if state is None else "lookups or settings": len(days)}
    else:
        before = spark.read.parquet(f"{folder}/runs/{state.run}/days")
        moved: dict[str, set] = {"visits": set(), "orders": set(), "coupons": set()}
        for r in _changed(before, now, ["kind", "day"]).collect():
            moved[r["kind"]].add(r["day"])
        members = _changed(spark.read.parquet(f"{folder}/runs/{state.run}/members"), spark.read.parquet(f"{folder}/runs/{run}/members"), ["member_key"])
        of_members = prepared.visits.join(members, "member_key", "left_semi").select("event_dt").distinct().collect()
        width = dt.timedelta(days=params.max_window)
        lines = sorted(moved["orders"])
        by = {
            "visits": moved["visits"] & event_days,
            "orders": {d for a, b in [(o - width, o) for o in lines if o > NO_DAY + width] for d in event_days if a <= d <= b},
            "coupons": moved["coupons"] & event_days,
            "members": {r["event_dt"] for r in of_members} & event_days,
        }
        days, reasons = set().union(*by.values()), {k: len(v) for k, v in by.items()}
        days |= event_days - set(state.days)
    gone = set(state.days if state else ()) - event_days
    return Touched(tuple(sorted(days)), tuple(sorted(gone)), len(event_days), reasons)


def _write_days(rows: DataFrame, path: str) -> None:
    """Report rows in a folder for each day.

    Rows are brought together by day first: otherwise every task writes a file
    for every day.  The rebalance splits a day of many rows over several tasks."""
    # As text: the folders of an early date are read back as they were written.
    day = F.date_format(F.coalesce("date_id", F.lit(NO_DAY)), "yyyy-MM-dd")
    rows.withColumn("_day", day).hint("rebalance", "_day").write.partitionBy("_day").parquet(path)


def _stored_rows(like: DataFrame, folder: str, days: dict[dt.date, str], part: str) -> DataFrame:
    """The report rows of all days, from the runs that computed them."""
    reader = like.sparkSession.read.schema(T.StructType([*like.schema.fields, T.StructField("_day", T.StringType())]))
    frames = [like.where("false")]
    for run in sorted(set(days.values())):
        own = [d.isoformat() for d, r in days.items() if r == run]
        frames.append(reader.parquet(f"{folder}/runs/{run}/{part}").where(F.col("_day").isin(own)).drop("_day"))
    return reduce(DataFrame.unionByName, frames[1:] or frames)


def incremental_campaign_performance(src: Sources, folder: str, params: Params = Params(),
                                     prepared: Prepared | None = None) -> tuple[DataFrame, Touched]:
    """The table of ``campaign_performance``, computing only what changed since
    the last run on the state ``folder``, and what that was."""
    if tuple(params.windows) != (0, 7, 30):
        raise ValueError("the 82-column table is defined for windows (0, 7, 30)")
    folder = folder.rstrip("/")
    spark = src.campaign_reservation.sparkSession
    state, run = load_state(spark, folder), uuid.uuid4().hex[:12]
    alive = set(state.days.values()) | {state.run} if state else set()
    for left in set(names(spark, f"{folder}/runs")) - alive:  # of runs that were not committed
        drop_path(spark, f"{folder}/runs/{left}")

    prepared = prepared or prepare(src, params)
    here = f"{folder}/runs/{run}"
    day_fingerprints(prepared, params).write.parquet(f"{here}/days")
    member_fingerprints(src, params).write.parquet(f"{here}/members")
    lookups = lookup_fingerprint(src)
    touched = _touched(prepared, params, state, folder, run, lookups)
    log.info("%d of %d event days touched, %d gone, by %s: %s", len(touched.days), touched.total, len(touched.gone), touched.reasons,
             [str(d) for d in touched.days[:40]])

    groups = stored(attributed_groups(src, params, _only(prepared, list(touched.days), params)), "attributed-groups")
    fresh = {"base0": same_day_report(groups, params, 0), "later": window_report(groups, params, (7, 30))}
    kept = {d: r for d, r in (state.days if state else {}).items() if d not in set(touched.days) | set(touched.gone)}
    together = len(set(kept.values())) >= MAX_RUNS
    for part, rows in fresh.items():
        if together:
            rows = rows.unionByName(_stored_rows(rows, folder, kept, part))
        _write_days(rows, f"{here}/{part}")
    days = {d: run for d in kept} if together else dict(kept)
    days |= {d: run for d in touched.days}
    write_text(spark, f"{folder}/manifests", str(state.number + 1 if state else 1), json.dumps({
        "run": run, "settings": _settings(params), "lookups": lookups, "days": {d.isoformat(): r for d, r in sorted(days.items())},
        "touched": {"days": [str(d) for d in touched.days], "gone": [str(d) for d in touched.gone], "total": touched.total, "reasons": touched.reasons}}))
    _clean(spark, folder, {run, *days.values()}, state.number if state else 0)

    base0, later = (_stored_rows(rows, folder, days, part) for part, rows in fresh.items())
    report = assemble_main(base0, count_reservations(prepared.src.campaign_reservation, params), {7: later, 30: later}, params)
    return report, touched


def _clean(spark: SparkSession, folder: str, alive: set[str], last: int) -> None:
    """Remove runs that no day needs any more, and manifests but the last two."""
    for run in set(names(spark, f"{folder}/runs")) - alive:
        drop_path(spark, f"{folder}/runs/{run}")
    for number in names(spark, f"{folder}/manifests"):
        if number.isdigit() and int(number) < last:
            drop_path(spark, f"{folder}/manifests/{number}")
