"""Broadcast only what the planner's own estimate proves small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int:
    """Upper estimate of the optimised plan, from file sizes and statistics.
    No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if it is estimated at ``max_bytes`` or less.

    Beyond that the join is left to Spark: a shuffle join, or a broadcast that
    adaptive execution decides from the measured shuffle size.
    """
    return F.broadcast(df) if 0 < estimated_bytes(df) <= max_bytes else df
