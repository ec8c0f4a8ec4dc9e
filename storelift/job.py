"""Daily refresh job: ``python -m storelift.job`` with PySpark installed, or
``spark-submit`` of a launcher containing ``from storelift.job import main;
main()`` with the package shipped by ``--py-files``.

Reads the seven inputs from the catalog (``--table role=name``) or from files
(``--path role=location``), builds both reports and replaces the contents of
the target tables, like the source's delete + insert statements, but both
together or neither (``sinks.refresh``).

    python -m storelift.job \\
        --table campaign_reservation=db.reservation ... \\
        --main-table reports.campaign_performance \\
        --sibling-table reports.in_store_activity
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys

from .operators.quarantine import set_apart
from .params import Params
from .plans.incremental import incremental_campaign_performance
from .plans.reports import campaign_performance, in_store_activity, prepare
from .session import drop_stored, get_session
from .sinks.refresh import Load, refresh_all
from .sources.schemas import SCHEMAS
from .sources.tables import Sources

log = logging.getLogger(__name__)


def _pairs(items: list[str], flag: str) -> dict[str, str]:
    out = {}
    for item in items:
        role, sep, value = item.partition("=")
        if not sep or role not in SCHEMAS:
            raise SystemExit(f"{flag} expects role=value with role in {sorted(SCHEMAS)}, got {item!r}")
        out[role] = value
    return out


def main(argv: list[str] | None = None) -> int:
    defaults = Params()
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--table", action="append", default=[], help="role=catalog table")
    ap.add_argument("--path", action="append", default=[], help="role=file location")
    ap.add_argument("--format", default="parquet", help="file format for --path inputs")
    ap.add_argument("--main-table", help="target of the 82-column report")
    ap.add_argument("--sibling-table", help="target of the 18-column report")
    ap.add_argument("--location", default=None, help="folder for target tables created on first run")
    ap.add_argument("--batch-ts", default=None, help="fixed load time (ISO), default now")
    ap.add_argument("--no-parity", action="store_true", help="count each member's window totals once")
    ap.add_argument("--order-date-format", default=None, help="format of a text date_id, e.g. yyyyMMdd")
    ap.add_argument("--on-bad-id", choices=("raise", "null", "quarantine"), default=defaults.on_bad_id, help="member ids that are no integer")
    ap.add_argument("--rejects-table", help="target of the rows set apart by --on-bad-id quarantine")
    ap.add_argument("--coupon-code", default=defaults.coupon_code)
    ap.add_argument("--main-distributor-like", default=defaults.main_distributor_like)
    ap.add_argument("--sibling-distributor", default=defaults.sibling_distributor)
    ap.add_argument("--excluded-order-distributor", default=defaults.excluded_order_distributor)
    ap.add_argument("--bucket-days", type=int, default=defaults.bucket_days, help="width of the range join's time buckets")
    ap.add_argument("--state", default=None, help="folder of the main report's state: only event days whose inputs changed are computed again")
    ap.add_argument("--journal", default=None, help="folder of the load journal, default <warehouse>/_refresh")
    ap.add_argument("--checkpoint-dir", default=None, help="shared folder for intermediates, where spark.checkpoint.dir is unset")
    args = ap.parse_args(argv)

    tables, paths = _pairs(args.table, "--table"), _pairs(args.path, "--path")
    missing = set(SCHEMAS) - set(tables) - set(paths)
    if missing:
        raise SystemExit(f"no input given for {sorted(missing)}")
    if not (args.main_table or args.sibling_table):
        raise SystemExit("nothing to do: give --main-table and/or --sibling-table")
    if args.rejects_table and args.on_bad_id != "quarantine":
        raise SystemExit("--rejects-table needs --on-bad-id quarantine")

    spark = get_session()
    if args.checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    frames = {r: spark.table(n) for r, n in tables.items()}
    frames.update({r: spark.read.format(args.format).load(p) for r, p in paths.items()})
    src = Sources(**frames)
    params = Params(
        batch_ts=dt.datetime.fromisoformat(args.batch_ts) if args.batch_ts else None,
        parity=not args.no_parity,
        order_date_format=args.order_date_format,
        on_bad_id=args.on_bad_id,
        coupon_code=args.coupon_code,
        main_distributor_like=args.main_distributor_like,
        sibling_distributor=args.sibling_distributor,
        excluded_order_distributor=args.excluded_order_distributor,
        bucket_days=args.bucket_days,
    )
    targets = [(t, build) for t, build in ((args.main_table, campaign_performance), (args.sibling_table, in_store_activity)) if t]
    try:
        loads = []
        if args.on_bad_id == "quarantine":
            apart = set_apart(src)
            src = apart.src
            log.warning("rows and rejected rows by input: %s", apart.counts)
            if args.rejects_table:
                loads.append(Load(apart.rejects, args.rejects_table, f"{args.location.rstrip('/')}/{args.rejects_table}" if args.location else None))
        prepared = prepare(src, params)
        for t, build in targets:
            if build is campaign_performance and args.state:
                report, _ = incremental_campaign_performance(src, args.state, params, prepared)
            else:
                report = build(src, params, prepared)
            loads.append(Load(report, t, f"{args.location.rstrip('/')}/{t}" if args.location else None))
        refresh_all(loads, args.journal)
    finally:
        drop_stored(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
