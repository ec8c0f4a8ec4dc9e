"""A Bloom filter of integer keys as one array value.

The filter has ``64 * words`` bits, ``words`` a power of two, and sets
``PROBES`` bits a key, all taken from one hash.  It is built by a tree of
aggregations (bits of a word, words of a chunk, chunks) and probed as a plain
column expression: the array is the value of a scalar subquery, so building the
query runs no job and the probe stays inside the scan's stage, before any exchange.

With v keys in m bits the share of other keys let through is about
(1 - exp(-PROBES * v / m)) ** PROBES; at the ``BITS_PER_KEY`` wanted it is 1.4 %.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 2
BITS_PER_KEY = 16
_CHUNK = 10  # a chunk is 2 ** 10 words
#: A filter that would let through more than this share is not worth its probe.
WORST_RATE = 0.5


def false_rate(keys: int, words: int) -> float:
    """Expected share of keys outside the filter that it lets through."""
    return (1 - math.exp(-PROBES * keys / (64 * words))) ** PROBES


def filter_words(keys: int, max_bits: int) -> int:
    """Words for about ``keys`` keys, at most ``max_bits`` bits; 0 if that is too few to be of use."""
    wanted = 1 << max(_CHUNK + 6, (BITS_PER_KEY * max(1, keys) - 1).bit_length())
    words = min(wanted, 1 << max(0, max_bits.bit_length() - 1)) // 64
    return words if words >= 1 << _CHUNK and false_rate(keys, words) <= WORST_RATE else 0


def _places(key: Column, words: int) -> list[Column]:
    """The bits of a key."""
    h, mask = F.xxhash64(key.cast("long")), F.lit(64 * words - 1).cast("long")
    return [h.bitwiseAND(mask), F.shiftright(h, 32).bitwiseAND(mask)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def member_filter(keys: DataFrame, column: str, words: int) -> DataFrame:
    """One row, one column: the filter's words as array<long>.

    At most ``words`` rows reach the second aggregation and ``words`` / 1024 the last.
    """
    set_bits = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column), words))).alias("place"))
    every = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    full = (set_bits.select(F.shiftright("place", 6).alias("word"), _bit(F.col("place")).alias("bits")).unionAll(every)
                    .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    ordered = lambda at, value: F.array_sort(F.collect_list(F.struct(at, value)))[value]
    chunks = full.groupBy(F.shiftright("word", _CHUNK).alias("chunk")).agg(ordered("word", "bits").alias("chunk_bits"))
    return chunks.agg(F.flatten(ordered("chunk", "chunk_bits")).alias("filter"))


def may_be_member(filter_row: DataFrame, key: Column, words: int) -> Column:
    """False only for keys that are not in the filter; true for NULL keys."""
    array = filter_row.scalar()
    hits = [F.get(array, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _places(key, words)]
    return key.isNull() | (hits[0] & hits[1])
