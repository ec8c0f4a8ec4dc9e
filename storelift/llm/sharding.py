"""Sharding by histogram sort.

Rows get a 64-bit sort key: the upper 40 bits hash the text, the lower 24 the
document id, so equal texts lie together while a text that holds a third of
all rows still spreads over 2^24 key values.  Shard boundaries are found by
counting, exactly and across all partitions, the bytes below candidate
boundaries ("probes").  Each pass splits only the key intervals that still
hold a boundary into 1,024 equal parts, so the probes close in on the
splitters by ten bits a pass, and a boundary is accepted as soon as the bytes
below it are within tolerance of its share.  Whole rows, texts and all other
columns included, then move once, to their range, and are written to the shared
folder by shard, in slot order within each file.  What the operator returns is
read back from these files.

The same search on row counts yields finer ranges (about ``ROWS_PER_RANGE``
rows each) inside the shards; they bound what one task sorts.  The driver
holds the probe counts of the open intervals and two numbers a range; both
are bounded by the number of ranges, not by rows.

Law ``bytes``: each boundary is within ``TOLERANCE`` of a shard's share, or at
the nearest document boundary where a document is larger than that.

Defined cases: a null text weighs 1 and has the CRC of no bytes, 0.  A null
doc_id sorts as the smallest long.  Rows alike in text and doc_id share one
key and stay in one shard.  With fewer rows than shards some shards are empty;
an empty table gives an empty result.  Other columns can have any name; they
travel inside one struct.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, stored

N_SHARDS = 16
#: Accepted deviation of the bytes below a boundary, as a part of one shard's bytes.
TOLERANCE = 0.005
ROWS_PER_RANGE = 50_000
MIN_RANGES = 64
#: Bits that one pass resolves.
PASS_BITS = 10


def sort_key(text: Column, doc_id: Column) -> Column:
    """40 bits of the text's hash above 24 bits of the id's, as a signed long
    in unsigned order minus 2^63 (so that long order is key order)."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 24), 24).bitwiseOR(
        F.shiftrightunsigned(F.xxhash64(doc_id), 40)).bitwiseXOR(F.lit(-(2**63)))


def splitters(keys: DataFrame, weight: Column, parts: int, tolerance: float) -> list[int]:
    """``parts`` - 1 boundaries; part i holds the keys from boundary i - 1 on
    and below boundary i.

    ``keys`` has a long column ``key``; ``tolerance`` is relative to the
    weight of one part.
    """
    unsigned = F.col("key").bitwiseXOR(F.lit(-(2**63)))
    weights = keys.select(unsigned.alias("key"), weight.cast("long").alias("w"))
    total = weights.agg(F.sum("w")).first()[0] or 0
    if not total:
        return []
    targets = [total * (i + 1) / parts for i in range(parts - 1)]
    slack = tolerance * total / parts
    found: dict[int, int] = {}
    # Open interval: first key, and the weight below it; targets inside.
    open_at = {0: (0, list(range(parts - 1)))}
    bits = 0
    while open_at and bits < 64:
        step = min(PASS_BITS, 64 - bits)
        bucket = F.shiftrightunsigned("key", 64 - bits - step)
        rows = weights
        if bits:
            at = [k >> (64 - bits) for k in open_at]
            parents = F.shiftrightunsigned("key", 64 - bits)
            if len(at) <= 1024:
                rows = rows.where(parents.isin(at))
            else:
                spark = keys.sparkSession
                rows = rows.withColumn("_p", parents).join(spark.createDataFrame([(a,) for a in at], "_p long"), "_p", "left_semi")
        counts = {r[0]: r[1] for r in rows.groupBy(bucket.alias("b")).agg(F.sum("w")).collect()}
        # The shift gives signed longs only for bits + step = 64.
        counts = {b & 0xFFFFFFFFFFFFFFFF: w for b, w in counts.items()}
        bits += step
        width = 1 << (64 - bits)
        by_parent: dict[int, list[tuple[int, int]]] = {}
        for b, w in sorted(counts.items()):
            by_parent.setdefault((b * width) >> (64 - bits + step) << (64 - bits + step), []).append((b * width, w))
        still: dict[int, tuple[int, list[int]]] = {}
        for first, (below, inside) in open_at.items():
            run, todo = below, iter(sorted(inside))
            t = next(todo, None)
            for key, w in by_parent.get(first, []):
                while t is not None and targets[t] <= run + w:
                    near = min((abs(targets[t] - run), key), (abs(run + w - targets[t]), key + width))
                    if near[0] <= slack or bits == 64:
                        found[t] = near[1]
                    else:
                        still.setdefault(key, (run, []))[1].append(t)
                    t = next(todo, None)
                run += w
            while t is not None:
                found[t] = 1 << 64
                t = next(todo, None)
        open_at = still
    return [found[t] - (1 << 63) for t in range(parts - 1)]


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE,
                 rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Write the rows of ``docs`` to ``path``: doc (all columns) and slot, in folders by shard.

    Slots number a shard's rows in key order from 0, ties by doc_id.
    """
    text = F.col("text")
    keys = stored(docs.select(_size(text).alias("size"), sort_key(text, F.col("doc_id")).alias("key")), "shard-keys")
    n_rows = keys.count()
    shard_cuts = splitters(keys, F.col("size"), n_shards, tolerance)
    n_ranges = max(MIN_RANGES, -(-n_rows // rows_per_range))
    range_cuts = splitters(keys, F.lit(1), n_ranges, 0.25)
    top = (1 << 63) - 1
    cuts = np.array(sorted({c for c in shard_cuts + range_cuts if c <= top}), np.int64)
    shards = np.array([c for c in shard_cuts if c <= top], np.int64)
    # Shard of each range: the number of shard boundaries at or below its start.
    shard_of = np.searchsorted(shards, np.concatenate(([np.iinfo(np.int64).min], cuts)), "right").astype(np.int32)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), "right").astype(np.int32))

    ranged = keys.withColumn("range", range_of("key"))
    in_range = {r[0]: r[1] for r in ranged.groupBy("range").count().collect()}
    base, seen = np.zeros(len(shard_of), np.int64), {}
    for r, shard in enumerate(shard_of.tolist()):
        base[r] = seen.get(shard, 0)
        seen[shard] = seen.get(shard, 0) + in_range.get(r, 0)
    lookup = keys.sparkSession.createDataFrame(
        pd.DataFrame({"range": np.arange(len(shard_of), dtype=np.int32), "shard": shard_of, "base": base}))
    order = Window.partitionBy("range").orderBy("key", "doc.doc_id", "_crc")
    moved = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), sort_key(text, F.col("doc_id")).alias("key"),
                        _crc(text).alias("_crc")).withColumn("range", range_of("key"))
    (moved.withColumn("_rank", F.row_number().over(order) - 1)
          .join(F.broadcast(lookup), "range")
          .select("doc", (F.col("base") + F.col("_rank")).cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))
          .sortWithinPartitions("shard", "slot")
          .write.partitionBy("shard").option("compression", "zstd").parquet(path))


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """doc, slot, shard as ``write_shards`` wrote them; ``docs`` gives the columns."""
    schema = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.lit(0).cast("long").alias("slot"),
                         F.lit(0).cast("int").alias("shard")).schema
    return docs.sparkSession.read.schema(schema).parquet(path)


def histogram_sort(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Writes the shards to the shared folder, reads them back and returns
    doc_id, size, text_crc32, key, shard, slot of every row."""
    path = f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex[:12]}"
    write_shards(docs, path, n_shards, tolerance, rows_per_range)
    text, doc_id = F.col("doc.text"), F.col("doc.doc_id")
    return read_shards(docs, path).select(
        doc_id.alias("doc_id"), _size(text).alias("size"), _crc(text).alias("text_crc32"), sort_key(text, doc_id).alias("key"), "shard", "slot")
