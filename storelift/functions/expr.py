"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def member_key(c: str | Column, params: Params) -> Column:
    """Integer member id from its text form (``x::integer``).

    Strict by default: under ANSI mode a non-integer text fails the job, as in
    the source warehouse.  ``on_bad_id='null'`` turns it into NULL instead.
    """
    c = col(c)
    return c.try_cast("int") if params.on_bad_id == "null" else c.cast("int")


def day_of(c: str | Column, fmt: str | None = None) -> Column:
    """``DATE(x)``: the calendar day of a timestamp or date, or of text in
    format ``fmt`` (e.g. ``'yyyyMMdd'`` for packed day ids, which a plain
    ANSI cast rejects)."""
    return F.to_date(col(c), fmt) if fmt else F.to_date(col(c))


def day_diff(later: str | Column, earlier: str | Column) -> Column:
    """``date - date`` in days, as an integer."""
    return F.datediff(col(later), col(earlier))


def label(a: str | Column, b: str | Column) -> Column:
    """``a || ' ' || b``: NULL when either side is NULL."""
    return F.concat(col(a), F.lit(" "), col(b))


def flag(cond: Column) -> Column:
    """``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def positive_amount(qty: str | Column, amt: str | Column) -> Column:
    return F.when(col(qty) > 0, col(amt)).otherwise(F.lit(0))


def returned_amount(qty: str | Column, amt: str | Column) -> Column:
    return F.when(col(qty) < 0, F.abs(col(amt))).otherwise(F.lit(0))


def money(c: str | Column) -> Column:
    """Published amount type."""
    return col(c).cast("decimal(18,2)")


def load_time(params: Params) -> Column:
    """``getdate()`` as a TIMESTAMP_NTZ in the session's time zone, or the
    fixed ``batch_ts`` (one with an offset is turned into that zone too)."""
    if params.batch_ts is not None:
        ts = params.batch_ts
        if ts.tzinfo is not None:
            return F.lit(ts).cast("timestamp_ntz")
        return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.localtimestamp()


def batch_date(params: Params) -> Column:
    """``to_char(getdate(), 'yyyymmdd')``: year, month, day (not minutes)."""
    return F.date_format(load_time(params), "yyyyMMdd")
