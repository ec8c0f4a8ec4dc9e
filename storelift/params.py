"""Run parameters of the campaign-performance jobs.

Every literal that decides which rows count lives here, so a deployment can
override it without touching the plans.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

# These must equal the source warehouse's codes exactly.
STATUS_CANCELLED = "已取消"  # reservation cancelled
STATUS_VERIFIED = "已核销"  # reservation checked in / verified
LIFECYCLE_FIRST_ORDER = "会员生命周期首单"  # first order of the member's life
RECRUITMENT_COUPON_CODE = "Q240065"
COUPON_STATUS_REDEEMED = "redeemed"
COUPON_CAMPAIGN_TYPE = "LTP"
EXCLUDED_ORDER_DISTRIBUTOR = "LBR"
MAIN_DISTRIBUTOR_PATTERN = "%LCS%"
SIBLING_DISTRIBUTOR = "LBR"
SOURCE_RESERVED = 1  # reserved in advance, then checked in
SOURCE_WALK_IN = 2  # checked in on the spot
WINDOWS = (0, 7, 30)


@dataclasses.dataclass(frozen=True)
class Params:
    """Literals and switches of one refresh run.

    ``parity`` keeps the source query's row multiplication in the 0/7/30-day
    amounts and order counts (see README, "Known repeats"); ``parity=False``
    gives each member's window totals once.  ``on_bad_id`` decides what a
    member id that is not an integer does: ``"raise"`` (ANSI cast, the source
    behaviour) or ``"null"`` (``try_cast``; the row then matches nothing).
    """

    cancelled_status: str = STATUS_CANCELLED
    verified_status: str = STATUS_VERIFIED
    first_order_lifecycle: str = LIFECYCLE_FIRST_ORDER
    coupon_code: str = RECRUITMENT_COUPON_CODE
    coupon_status: str = COUPON_STATUS_REDEEMED
    coupon_campaign_type: str = COUPON_CAMPAIGN_TYPE
    excluded_order_distributor: str = EXCLUDED_ORDER_DISTRIBUTOR
    main_distributor_like: str = MAIN_DISTRIBUTOR_PATTERN
    sibling_distributor: str = SIBLING_DISTRIBUTOR
    source_reserved: int = SOURCE_RESERVED
    source_walk_in: int = SOURCE_WALK_IN
    windows: tuple[int, ...] = WINDOWS
    parity: bool = True
    on_bad_id: str = "raise"
    # Format of a text ``date_id`` on the order lines (e.g. "yyyyMMdd");
    # None when it is a DATE or TIMESTAMP.
    order_date_format: str | None = None
    # Width in days of the time buckets of the range join; must be >= the
    # largest window.  Rows of the order side within max(windows) days of a
    # bucket start are also sent to the previous bucket.
    bucket_days: int = 120
    # Lookups whose plan is estimated at this many bytes or less are broadcast;
    # for others Spark decides (adaptively, from the measured size).  0: never.
    broadcast_max_bytes: int = 32 << 20
    # Fixed load time for repeatable runs; None means the current time.
    batch_ts: _dt.datetime | None = None
    # Write the attributed participation groups (Parquet in the session's
    # shared folder) before the same-day and 7/30-day reports branch off them:
    # computed once, read with pruned columns, and lineage is cut there.
    store_groups: bool = True
    # Read only order lines that can fall in a window: from the first to the
    # last verified event day + max(windows).  The bound reaches the scan as
    # a pushed filter (partition pruning / row-group skipping on date_id).
    prune_order_days: bool = True
    # Largest Bloom filter of visiting members that the order lines are probed
    # with before their first shuffle, in bits (16 a member are wanted; a filter
    # that would let half of the others through is left out).  0: no filter.
    member_filter_max_bits: int = 1 << 27
    # Windowed attribution: "join" (bucketed range join) or "sweep" (one sorted
    # pass with range frames).  Distinct members: "rows" (a row per member) or
    # "bitmap" (a bitmap per 32,768 member numbers).  Same results.
    attribution: str = "join"
    distinct: str = "rows"

    def __post_init__(self) -> None:
        if not self.windows or min(self.windows) < 0:
            raise ValueError("windows must be non-negative day counts")
        if self.bucket_days < max(self.windows) or self.bucket_days < 1:
            raise ValueError("bucket_days must be at least the largest window")
        if self.on_bad_id not in ("raise", "null", "quarantine"):
            raise ValueError("on_bad_id must be 'raise', 'null' or 'quarantine'")
        if self.attribution not in ("join", "sweep") or self.distinct not in ("rows", "bitmap"):
            raise ValueError("attribution must be 'join' or 'sweep', distinct 'rows' or 'bitmap'")

    @property
    def max_window(self) -> int:
        return max(self.windows)
