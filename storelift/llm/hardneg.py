"""Hard-negative mining with rotated one-bit codes.

Components become floor(``SCALE`` * x); a score is an integer inner product.
An anchor's positives are its best rows of the same label.  For each positive,
its hard negatives are the best rows of other labels whose score lies between
``LOW`` and ``HIGH`` hundredths of the positive's.

Every row is rotated by one fixed random orthogonal matrix and stored as
``STAGES`` one-bit codes: the signs of the rotated vector, then of what remains
of it, and so on.  Beside each code stands its alignment a, the inner product of
the unit sign vector and the vector it codes, and beside all the length of the
last remainder.  An anchor's rotated vector is cut into ``PLANES`` bit planes.
The inner product of a code and the planes is a sum of popcounts, so

    estimate = sum over stages of a * <sign vector, planes>

and by Cauchy-Schwarz the true score is within

    |remainder| * |anchor| + |coded vector| * |anchor - planes|

of it.  This interval is deterministic: no row outside it is ever missed.  In
each block the rows of best estimate are scored in integers first; they fix the
score that a row must be able to reach, and only rows whose interval meets it
are scored in integers.

Anchors (a stated query set) meet all rows in blocks: rows are dealt by a hash
to blocks of about ``BLOCK_ROWS``, anchors to blocks of about
``BLOCK_ANCHORS``, and a task holds one block of each.  A block answers with at
most the wanted number of rows for each anchor and positive; the best are chosen
over all blocks.  Labels play no part in the dealing, so a label that holds a
third of all rows is spread like any other.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part, nor do rows with a component beyond 2^31 - 1 or beyond
the size at which an inner product may exceed 64 bits.  Rows alike in id, label
and vector are one row; others that share an id are rows of their own, ordered
after the id by a hash of label and vector.  Vectors of different lengths are
never paired; the score of empty vectors is 0.  An anchor without positives, and
a positive of negative score, have no hard negatives.  An empty table gives an
empty result.  Only vec_id, label and embedding are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

SCALE = 256
ANCHOR_STEP = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
STAGES = 4
PLANES = 7
BLOCK_ROWS = 8_192
BLOCK_ANCHORS = 2_048
#: Anchors estimated at once, rows scored first for each, and pairs scored at once.
CHUNK = 64
AHEAD = 24
PAIRS = 1 << 17
#: Relative margin for rounding in estimates and intervals.
MARGIN = 1e-9
_SEED = 20_250_311


@functools.lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(_SEED).normal(size=(width, width)))[0]


def padded(dim: int) -> int:
    """Length of codes: whole 64-bit words."""
    return max(64, -(-dim // 64) * 64)


def rotated(x: np.ndarray) -> np.ndarray:
    width = padded(x.shape[1])
    return np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1]))) @ rotation(width)


def _words(bits: np.ndarray) -> np.ndarray:
    """(..., width) booleans as (..., width / 64) words."""
    return np.packbits(bits, axis=-1).view(np.uint64)


def one_bit_codes(x: np.ndarray, stages: int = STAGES) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, stages, words) of integer rows and (rows, stages + 2):
    alignments, length of the remainder, length of the coded vector."""
    rest = rotated(x)
    width = rest.shape[1]
    codes, fit = [], []
    coded = np.zeros_like(rest)
    for _ in range(stages):
        signs = rest > 0
        unit = np.where(signs, 1.0, -1.0) / math.sqrt(width)
        a = (rest * unit).sum(axis=1)
        coded += a[:, None] * unit
        rest = rest - a[:, None] * unit
        codes.append(_words(signs))
        fit.append(a)
    fit += [np.sqrt((rest * rest).sum(axis=1)), np.sqrt((coded * coded).sum(axis=1))]
    return np.stack(codes, axis=1), np.stack(fit, axis=1)


class Anchors:
    """Bit planes of a chunk of anchors."""

    def __init__(self, x: np.ndarray):
        q = rotated(x)
        self.width = q.shape[1]
        self.low = q.min(axis=1)
        self.step = np.maximum((q.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((q - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.sum = level.sum(axis=1)
        self.planes = [_words((level >> j & 1).astype(bool)) for j in range(PLANES)]
        gap = q - (self.low[:, None] + self.step[:, None] * level)
        self.off = np.sqrt((gap * gap).sum(axis=1))
        self.length = np.sqrt((q * q).sum(axis=1))

    def intervals(self, codes: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchors, rows) estimates and half widths."""
        shape = (len(self.low), len(codes))
        estimate = np.zeros(shape)
        stages = codes.shape[1]
        for s in range(stages):
            dot = np.zeros(shape, np.int32)
            ones = np.zeros(len(codes), np.int32)
            for w in range(codes.shape[2]):
                word = np.ascontiguousarray(codes[:, s, w])
                ones += np.bitwise_count(word)
                for j, plane in enumerate(self.planes):
                    dot += np.bitwise_count(word[None] & plane[:, w, None]).astype(np.int32) << j
            signed = self.low[:, None] * (2 * ones - self.width)[None] + self.step[:, None] * (2 * dot - self.sum[:, None])
            estimate += signed * (fit[:, s] / math.sqrt(self.width))[None]
        half = self.length[:, None] * fit[None, :, stages] + self.off[:, None] * fit[None, :, stages + 1]
        norm = np.sqrt((fit[:, :stages] ** 2).sum(axis=1) + fit[:, stages] ** 2)
        return estimate, half + MARGIN * (self.length[:, None] * norm[None] + 1)


def integer_scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of rows a[i] and b[j]."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), PAIRS):
        s = slice(k, k + PAIRS)
        out[s] = np.einsum("pd,pd->p", a[i[s]], b[j[s]])
    return out


def _best(i: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` best of each i: highest score, smallest id and key."""
    order = np.lexsort((keys, ids, -score, i))
    own = i[order]
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
    place = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[place < count]


class Block:
    """One block of rows or anchors as arrays."""

    def __init__(self, pdf: pd.DataFrame):
        self.n = len(pdf)
        self.ids, self.keys = pdf["vec_id"].to_numpy(np.int64), pdf["key"].to_numpy(np.int64)
        self.labels = pdf["label"].to_numpy()
        self.x = np.frombuffer(b"".join(pdf["x"]), np.int32).reshape(self.n, -1).astype(np.int64)
        if "codes" in pdf:
            width = padded(self.x.shape[1]) // 64
            self.codes = np.frombuffer(b"".join(pdf["codes"]), np.uint64).reshape(self.n, -1, width)
            self.fit = np.frombuffer(b"".join(pdf["fit"]), np.float64).reshape(self.n, -1)


def _positives(count: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            r, a = Block(rows), Block(anchors)
            for label in set(a.labels.tolist()) & set(r.labels.tolist()):
                mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(r.labels == label)
                for k in range(0, len(mine), CHUNK):
                    q = mine[k : k + CHUNK]
                    estimate, half = Anchors(a.x[q]).intervals(r.codes[theirs], r.fit[theirs])
                    other = ~((r.ids[theirs][None] == a.ids[q][:, None]) & (r.keys[theirs][None] == a.keys[q][:, None]))
                    estimate[~other] = -np.inf
                    # The best estimates, scored, give a score that the positives reach at least.
                    take = min(count + 1, len(theirs))
                    ahead = np.argpartition(-estimate, take - 1, axis=1)[:, :take]
                    i, j = np.repeat(np.arange(len(q)), take), ahead.ravel()
                    score = np.where(other[i, j], integer_scores(a.x[q], r.x[theirs], i, j), np.iinfo(np.int64).min).reshape(len(q), take)
                    least = -np.sort(-score, axis=1)[:, min(count, take) - 1].astype(np.float64)
                    i, j = np.nonzero(other & (estimate + half >= least[:, None]))
                    score = integer_scores(a.x[q], r.x[theirs], i, j)
                    j = theirs[j]
                    b = _best(i, score, r.ids[j], r.keys[j], count)
                    out.append((a.ids[q][i[b]], a.keys[q][i[b]], r.ids[j[b]], r.keys[j[b]], score[b]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5
        return pd.DataFrame(dict(zip(("anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score"), cols)))

    return run


def _negatives(count: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            r, a = Block(rows), Block(anchors)
            places = max(len(v) for v in anchors["low"])
            # Bands of the anchors' positives; places without one have an empty band.
            low, high = np.full((a.n, places), 1, np.int64), np.zeros((a.n, places), np.int64)
            for k, (lo, hi) in enumerate(zip(anchors["low"], anchors["high"])):
                low[k, : len(lo)], high[k, : len(hi)] = lo, hi
            for k in range(0, a.n, CHUNK):
                q = np.arange(k, min(k + CHUNK, a.n))
                estimate, half = Anchors(a.x[q]).intervals(r.codes, r.fit)
                other = r.labels[None] != a.labels[q][:, None]
                # The best estimates under the highest band's end, scored, give each band a score to reach.
                top = high[q].max(axis=1)
                take = min(AHEAD, r.n)
                under = np.where(other & (estimate <= top[:, None]), estimate, -np.inf)
                ahead = np.argpartition(-under, take - 1, axis=1)[:, :take]
                i, j = np.repeat(np.arange(len(q)), take), ahead.ravel()
                score = integer_scores(a.x[q], r.x, i, j).reshape(len(q), take)
                known = other[i, j].reshape(len(q), take)
                reach = np.zeros(estimate.shape, bool)
                for p in range(places):
                    lo, hi = low[q, p], high[q, p]
                    inside = known & (score >= lo[:, None]) & (score <= hi[:, None])
                    least = -np.sort(-np.where(inside, score, np.iinfo(np.int64).min), axis=1)[:, min(count, take) - 1]
                    if take < count:
                        least[:] = np.iinfo(np.int64).min
                    least = np.maximum(least, lo)
                    reach |= ((estimate + half >= least[:, None]) & (estimate - half <= hi[:, None]) & (lo <= hi)[:, None])
                i, j = np.nonzero(reach & other)
                score = integer_scores(a.x[q], r.x, i, j)
                for p in range(places):
                    inside = np.flatnonzero((score >= low[q, p][i]) & (score <= high[q, p][i]))
                    ii, jj, ss = i[inside], j[inside], score[inside]
                    b = _best(ii, ss, r.ids[jj], r.keys[jj], count)
                    out.append((a.ids[q][ii[b]], a.keys[q][ii[b]], np.full(len(b), p), r.ids[jj[b]], r.keys[jj[b]], ss[b]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 6
        return pd.DataFrame(dict(zip(("anchor_id", "anchor_key", "place", "negative_id", "negative_key", "negative_score"), cols)))

    return run


def coded_rows(vectors: DataFrame, scale: int = SCALE, stages: int = STAGES) -> DataFrame:
    """vec_id, key, label, dim, x (integers), codes and fit of the rows that take part."""
    usable = vectors.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = usable.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, own in pdf.groupby(pdf["embedding"].map(len), sort=True):
                x = np.floor(np.stack([np.asarray(v, np.float64) for v in own["embedding"]]) * scale).reshape(len(own), dim)
                limit = min((1 << 31) - 1, math.isqrt(((1 << 63) - 1) // max(1, dim)))
                fits = (np.abs(x) <= limit).all(axis=1)
                if not fits.any():
                    continue
                x = x[fits].astype(np.int64) if dim else np.zeros((len(own), 1), np.int64)
                codes, fit = one_bit_codes(x, stages)
                yield pd.DataFrame({"vec_id": own["vec_id"][fits], "label": own["label"][fits], "dim": np.int32(dim),
                                    "x": [v.tobytes() for v in x.astype(np.int32)], "codes": [c.tobytes() for c in codes],
                                    "fit": [f.tobytes() for f in fit]})

    kind = dict(vectors.dtypes)["label"]
    coded = rows.mapInPandas(code, f"vec_id long, label {kind}, dim int, x binary, codes binary, fit binary")
    return coded.withColumn("key", F.xxhash64("label", "x")).dropDuplicates(["vec_id", "key"])


def mine(vectors: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for the anchors: rows whose id ``anchor_step`` divides."""
    index = stored(coded_rows(vectors, scale), "hardneg-rows")
    is_anchor = F.pmod("vec_id", F.lit(anchor_step)) == 0
    counts = index.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    row_blocks, anchor_blocks = max(1, -(-counts["rows"] // block_rows)), max(1, -(-counts["anchors"] // block_anchors))
    dealt = F.xxhash64("vec_id", "key", F.lit(1))

    def row_side() -> DataFrame:
        return index.withColumn("row_block", F.pmod(dealt, F.lit(row_blocks))).withColumn(
            "anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))

    def anchor_side(anchors: DataFrame) -> DataFrame:
        return anchors.withColumn("anchor_block", F.pmod(dealt, F.lit(anchor_blocks)).cast("int")).withColumn(
            "row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))))

    keys = ["dim", "row_block", "anchor_block"]
    anchors = stored(index.where(is_anchor).select("vec_id", "key", "label", "dim", "x"), "hardneg-anchors")
    found = (row_side().groupBy(*keys).cogroup(anchor_side(anchors).groupBy(*keys))
             .applyInPandas(_positives(positives), "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long"))
    order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("positive_score"), "positive_id", "positive_key")
    best = stored(found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives), "hardneg-positives")

    # A positive's band, in whole scores: 100 * s from low * p to high * p.
    p = F.col("positive_score").cast("decimal(38,0)")
    bands = (best.where("positive_score >= 0")
                 .groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(F.struct(
                     "place", F.ceil(p * low / 100).cast("long").alias("low"), F.floor(p * high / 100).cast("long").alias("high")))).alias("bands")))
    asked = (anchors.join(bands, (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key")))
                    .select("vec_id", "key", "label", "dim", "x", F.col("bands.low").alias("low"), F.col("bands.high").alias("high")))
    hits = (row_side().groupBy(*keys).cogroup(anchor_side(asked).groupBy(*keys))
            .applyInPandas(_negatives(negatives), "anchor_id long, anchor_key long, place int, negative_id long, negative_key long, negative_score long"))
    order = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_key")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(best, ["anchor_id", "anchor_key", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
