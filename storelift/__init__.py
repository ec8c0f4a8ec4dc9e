"""Campaign performance analytics as Spark DataFrame jobs.

The two reports are ``campaign_performance`` (82 columns) and
``in_store_activity`` (18 columns); the operators they are built from are
exported too, for use on their own.
"""

from .operators.assemble import MAIN_COLUMNS, SIBLING_COLUMNS
from .operators.attribution import visit_window_stats, window_join
from .operators.diagnostics import dimension_key_report
from .operators.metrics import kpi_ratios, participation_metrics, same_day_report, window_report
from .operators.participations import flag_redemption, new_member_tag, participations
from .operators.reservations import count_reservations
from .operators.rollups import daily_activity, daily_net_sales, daily_orders
from .params import Params
from .plans.reports import attributed_groups, campaign_performance, in_store_activity
from .sinks.refresh import refresh
from .sources.tables import Sources

__all__ = [
    "MAIN_COLUMNS", "SIBLING_COLUMNS", "Params", "Sources", "attributed_groups", "campaign_performance",
    "count_reservations", "daily_activity", "daily_net_sales", "daily_orders", "dimension_key_report",
    "flag_redemption", "in_store_activity", "kpi_ratios", "new_member_tag", "participation_metrics",
    "participations", "refresh", "same_day_report", "visit_window_stats", "window_join", "window_report",
]
