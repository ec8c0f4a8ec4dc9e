"""Rows with malformed member ids, set apart (``on_bad_id="quarantine"``).

The source's cast fails the whole load at the first id that is no integer.  Here one
pass over each input that names members writes the columns in use with a mark
on the rows whose id text is not an integer; the reports read the unmarked rows, and
the marked ones become a table of rejects for correction and reload.  An
``Observation`` of the same pass counts both.  NULL ids are no rejects: they
are part of the source's semantics.

The pass writes each of the four inputs once, narrow, to the shared folder: the price of
two outputs from one read.
"""

from __future__ import annotations

import dataclasses
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stored
from ..sources.schemas import SCHEMAS
from ..sources.tables import Sources

# The member id text of each input that has one.
MEMBER_TEXT = {
    "campaign_reservation": "type_value",
    "member_detail": "member_detail_id",
    "coupon_benefit": "member_detail_id",
    "member_order_detail": "crm_member_id",
}


@dataclasses.dataclass(frozen=True)
class Quarantined:
    """Inputs without the rejected rows; the rejects (input, reason, raw_id, row as
    JSON); and for each input how many rows it had and how many were rejected."""

    src: Sources
    rejects: DataFrame
    counts: dict[str, tuple[int, int]]


def set_apart(src: Sources) -> Quarantined:
    """Split the four inputs that name members."""
    clean, rejects, counts = {}, [], {}
    for role, column in MEMBER_TEXT.items():
        names = [f.name for f in SCHEMAS[role].fields]
        text = F.col(column)
        number = text.try_cast("decimal(38,0)")
        reason = (F.when(text.isNull() | text.try_cast("int").isNotNull(), F.lit(None)).when(F.trim(text) == "", F.lit("empty"))
                   .when(number.isNotNull() & (F.abs(number) > 2147483647), F.lit("out of range")).otherwise(F.lit("not an integer")))
        seen = Observation(f"{role}-{uuid.uuid4().hex}")
        marked = getattr(src, role).select(*names).withColumn("_reason", reason.cast("string"))
        checked = stored(marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("rejected")), f"{role}-checked")
        counts[role] = (seen.get["rows"], seen.get["rejected"])
        clean[role] = checked.where("_reason IS NULL").drop("_reason")
        rejects.append(checked.where("_reason IS NOT NULL").select(
            F.lit(role).alias("input"), F.col("_reason").alias("reason"), F.col(column).alias("raw_id"), F.to_json(F.struct(*names)).alias("row")))
    return Quarantined(dataclasses.replace(src, **clean), reduce(DataFrame.unionAll, rejects), counts)
