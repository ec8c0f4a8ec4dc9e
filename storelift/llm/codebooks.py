"""Vector codes: product quantisation in integers with LAESA pivots.

A vector's components become floor(``SCALE`` * x), the vector ``PARTS`` equal
consecutive parts, and a part the index of the nearest entry of its position's
codebook.  The codebooks start as the parts of the ``ENTRIES`` smallest ids and
are refined in ``ROUNDS`` rounds: assign every part, then replace each entry
by the componentwise floor of its parts' mean.

Nearest entries are found as in LAESA.  Each position has ``PIVOTS`` fixed
pivots, far apart among its first entries.  The distances of every part to
the pivots are computed once and stored beside the integers.  A round computes
only the distances of the pivots to the current entries; the largest difference
of the two over all pivots bounds a part's distance to an entry from below
(triangle inequality).  The entries of smallest bound are evaluated first, in
integers, then those whose bound does not exceed the distance found, in the
order of their bounds, a wave at a time; the rest are pruned.  Bounds are
single-precision with a margin for rounding, so pruning never loses the nearest
entry and ties go to the lower index.

A round is one scan of the stored table.  Tasks send one row for each
(position, entry) with the sum and number of its parts, summed again before
they reach the driver: ``PARTS`` * ``ENTRIES`` rows, whatever the table's size.

Defined cases: null vectors and those with null or non-finite components are
dropped.  Vectors whose length is not the most common one (the smaller of
equally common ones), and vectors with a component too large for squared
distances of 64 bits, come back with null code and error and take no other
part.  A length that ``PARTS`` does not divide is filled up with zeros.  Rows
alike in id each count; equal ids are ordered by their vectors, null ids come
last.  With fewer than ``ENTRIES`` rows the codebooks have as many entries.
An empty table gives an empty result.  Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.broadcast import broadcast_if_small
from ..session import stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 12
#: Rows whose bounds are computed at once, and entries a wave evaluates for each row.
CHUNK = 1024
WAVES = (2, 6, 24)
#: Relative margin of single-precision bounds.
MARGIN = np.float32(2e-6)
LABELS_BYTES = 8 << 20


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` entries, each the farthest from those before it."""
    chosen, gap = [0], squares(entries, entries[0])
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squares(entries, entries[chosen[-1]]))
    return entries[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances in single precision."""
    return np.sqrt(np.stack([squares(x, p) for p in pivots], axis=-1).astype(np.float64)).astype(np.float32)


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, of_entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to each row's nearest entry, and the
    number of distances evaluated.  ``of_entries``: the entries' pivot distances."""
    n, count = len(x), len(entries)
    bound = np.zeros((n, count), np.float32)
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_entries[None, :, p]), out=bound)
    bound -= MARGIN * (to_pivots.max(axis=1, keepdims=True) + of_entries.max())
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.full(n, count)
    done, evaluated = 0, 0
    rows = np.arange(n)
    for wave in (*WAVES, count):
        upto = min(wave, count)
        if upto == done or not len(rows):
            continue
        if upto < count:  # the smallest bounds not evaluated yet
            open_ = bound[rows]
            at = np.argpartition(open_, upto - done - 1, axis=1)[:, : upto - done]
            i, e = np.repeat(rows, upto - done), at.ravel()
        else:
            a, e = np.nonzero(bound[rows] <= np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + 1e-12) if done else np.ones((n, count), bool))
            i = rows[a]
        if done and upto < count:
            live = bound[i, e] <= np.sqrt(best[i].astype(np.float64)) * (1 + 1e-12)
            bound[i, e] = np.inf
            i, e = i[live], e[live]
        else:
            bound[i, e] = np.inf
        for a in range(0, len(i), 1 << 16):
            ii, ee = i[a : a + (1 << 16)], e[a : a + (1 << 16)]
            d = squares(x[ii], entries[ee])
            evaluated += len(d)
            before = best[ii]
            np.minimum.at(best, ii, d)
            index[ii[best[ii] < before]] = count  # a nearer entry voids the index of the former one
            hit = d == best[ii]
            np.minimum.at(index, ii[hit], ee[hit])
        # Rows whose smallest open bound exceeds the distance found are settled.
        rows = rows[bound[rows].min(axis=1) <= np.sqrt(best[rows].astype(np.float64)) * (1 + 1e-12)]
        done = upto
    return index, best, evaluated


class Coder:
    """The current codebooks (parts, entries, part length) and the pivots."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray] | None = None):
        self.entries = entries
        self.pivots = pivots or [far_apart(e, PIVOTS) for e in entries]
        self.of_entries = [pivot_distances(e, p) for e, p in zip(self.entries, self.pivots)]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(rows, all pivots of all positions) of integer rows (rows, parts, length)."""
        return np.concatenate([pivot_distances(x[:, k], p) for k, p in enumerate(self.pivots)], axis=1)

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) codes and squared distances."""
        code, error = np.empty(x.shape[:2], np.int64), np.empty(x.shape[:2], np.int64)
        begin = np.cumsum([0] + [len(p) for p in self.pivots])
        for a in range(0, len(x), CHUNK):
            rows = slice(a, a + CHUNK)
            for k, entries in enumerate(self.entries):
                own = to_pivots[rows, begin[k] : begin[k + 1]]
                code[rows, k], error[rows, k], _ = nearest_entries(x[rows, k], own, entries, self.of_entries[k])
        return code, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vectors, scale: int, parts: int) -> np.ndarray:
    """(rows, parts, length) floors of the scaled components, filled up with zeros."""
    x = np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * scale).astype(np.int64)
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -(-x.shape[1] // parts))


def _frames(batches: Iterator[pd.DataFrame], shape: tuple[int, int], pivots: int):
    """Each stored batch with its integers and pivot distances."""
    for pdf in batches:
        if len(pdf):
            x = np.frombuffer(b"".join(pdf["x"]), np.int32).reshape(len(pdf), *shape).astype(np.int64)
            yield pdf, x, np.frombuffer(b"".join(pdf["pivots"]), np.float32).reshape(len(pdf), pivots)


def _partial_sums(coder: Coder) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros_like(coder.entries)
        number = np.zeros(coder.entries.shape[:2], np.int64)
        for _, x, d in _frames(batches, (coder.entries.shape[0], coder.entries.shape[2]), sum(map(len, coder.pivots))):
            code, _ = coder.assign(x, d)
            for k in range(x.shape[1]):
                order = np.argsort(code[:, k], kind="stable")
                used, first = np.unique(code[order, k], return_index=True)
                total[k, used] += np.add.reduceat(x[order, k], first, axis=0)
                number[k, used] += np.diff(np.append(first, len(order)))
        k, e = np.nonzero(number)
        if len(k):
            yield pd.DataFrame({"position": k.astype(np.int32), "entry": e.astype(np.int32), "number": number[k, e], "total": list(total[k, e])})

    return run


def refine(prepared: DataFrame, coder: Coder) -> Coder:
    """The coder after one round."""
    sums = prepared.mapInPandas(_partial_sums(coder), "position int, entry int, number long, total array<long>")
    totals = F.array(*[F.sum(F.col("total")[i]) for i in range(coder.entries.shape[2])]).cast("array<long>")
    entries = coder.entries.copy()
    for r in sums.groupBy("position", "entry").agg(F.sum("number").alias("number"), totals.alias("total")).collect():
        entries[r["position"], r["entry"]] = np.array(r["total"], np.int64) // r["number"]
    return Coder(entries, coder.pivots)


def encode(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256: a code has two hex digits a part")
    out_schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (vectors.where(F.col("embedding").isNotNull()).where(finite)
                   .select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")))
    size = F.size("embedding")
    length = kept.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], out_schema)
    dim = length["n"]
    limit = math.isqrt(((1 << 63) - 1) // max(1, dim)) // 2 - 1
    coded_here = (size == dim) & F.forall("embedding", lambda x: F.abs(x) * scale <= limit)
    given = kept.where(coded_here)
    first = given.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    if first:
        coder = Coder(integers([r["embedding"] for r in first], scale, parts).transpose(1, 0, 2).copy())
    else:
        coder = Coder(np.zeros((parts, 1, 0), np.int64))

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = integers(pdf["embedding"], scale, parts)
                yield pdf[["vec_id", "label"]].assign(x=[v.tobytes() for v in x.astype(np.int32)], pivots=[v.tobytes() for v in coder.distances(x)])

    label_type = dict(kept.dtypes)["label"]
    prepared = stored(given.mapInPandas(prepare, f"vec_id long, label {label_type}, x binary, pivots binary"), "codebooks-rows")
    for _ in range(rounds):
        coder = refine(prepared, coder)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, x, d in _frames(batches, (coder.entries.shape[0], coder.entries.shape[2]), sum(map(len, coder.pivots))):
            code, error = coder.assign(x, d)
            yield pdf[["vec_id", "label"]].assign(code=[bytes(c.tolist()).hex() for c in code], error=error.sum(axis=1))

    coded = prepared.mapInPandas(finish, f"vec_id long, label {label_type}, code string, error long")
    apart = kept.where(~coded_here).selectExpr("vec_id", "label", "CAST(NULL AS STRING) AS code", "CAST(NULL AS BIGINT) AS error")
    rows = stored(coded.unionAll(apart), "codebooks-coded")
    # Sums beyond a long stay at the largest one.
    most = F.lit((1 << 63) - 1).cast("decimal(30,0)")
    total = F.when(F.count("error") > 0, F.least(F.sum(F.col("error").cast("decimal(20,0)")), most)).cast("long")
    of_label = stored(rows.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error")), "codebooks-labels")
    joined = rows.join(broadcast_if_small(of_label, LABELS_BYTES), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(coder.digest()).alias("codebooks_sha256"))
