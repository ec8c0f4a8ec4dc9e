"""Exact distinct members by bitmaps (the other form of AGG-1 and AGG-11).

A member text is a place in a bitmap: texts that are whole numbers count by their
value, one class of bitmaps for plain numbers and one for each width of
zero-padded ones, so text variants of a number stay distinct members; any other
text is a class of its own.  A class's numbers fall into buckets of 32,768, and one
bitmap (4 KB) stands for all members of a (keys, class, bucket), however
often they occur.  Bitmaps are built before the shuffle and merged after it.

This pays where a key's members are many and their numbers dense: one row
replaces up to 32,768.  Where they are few and scattered each bitmap holds one
member, and the row per member of ``metrics`` and ``reservations`` is smaller;
hence the default of ``Params.distinct``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap (fixed by Spark's bitmap functions).
BITS = 8 * 4096


def member_places(df: DataFrame, member: str) -> DataFrame:
    """``df`` with the columns _class, _bucket and _place of a member text, all
    NULL for a NULL text (which adds no member, but keeps its keys)."""
    text = F.col(member)
    number = text.try_cast("long")
    # Eighteen digits fit a long; the class of a padded text is its width.
    digits = text.rlike("^[0-9]{1,18}$")
    plain = digits & (number.cast("string") == text)
    placed = df.withColumns({
        "_class": F.when(plain, F.lit("")).when(digits, F.length(text).cast("string")).otherwise(F.concat(F.lit("="), text)),
        "_number": F.when(digits, number + 1).when(text.isNotNull(), F.lit(1)),
    })
    return placed.withColumns({"_bucket": F.bitmap_bucket_number("_number"), "_place": F.bitmap_bit_position("_number")}).drop("_number")


def member_bitmaps(df: DataFrame, keys: Sequence[str], member: str, counts: Mapping[str, str]) -> DataFrame:
    """One row per (keys, class, bucket) with a bitmap for each name of
    ``counts``: the members of rows on which its condition holds."""
    built = [F.bitmap_construct_agg(F.expr(f"CASE WHEN {cond} THEN _place END")).alias(name) for name, cond in counts.items()]
    return member_places(df, member).groupBy(*keys, "_class", "_bucket").agg(*built)


def coarser(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer keys, from those of more: members are counted once."""
    return bitmaps.groupBy(*keys, "_class", "_bucket").agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def counted(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct members per ``keys``."""
    return bitmaps.groupBy(*keys).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
