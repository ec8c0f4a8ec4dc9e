"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a string of ``BITS`` signs of projections on
random orthogonal directions.  A tree's index is a sorted array of these
strings, dealt into buckets by their first characters.  A query descends every
tree to the strings that share its prefix, found by binary search, and counts
the matches for every prefix length.  The prefix length then ascends
synchronously in all trees, from the longest, until the trees together hold
enough matches (``MIN_MATCHES`` and ``MATCH_SHARE`` of all vectors, repeats
counted); those candidates are scored in double precision, all that the last
place can go to, ties included.

Two passes over the same buckets: counts first (summed over trees to fix each
query's prefix length), candidates second (each bucket scores its own and
passes on its best).  Buckets are dealt by a first few characters, so many that
the wanted length is longer; queries that still find too few ascend on
with shorter bucket prefixes, down to the root, which holds every vector.
A bucket is split by salt so that no task holds more than about
``BUCKET_ROWS`` vectors; counts and best lists of the splits add up.

Equal vectors form one class and are indexed once.  A class answers with its
smallest ids, one more than the neighbours asked for; larger ids of the same
class can never be among the nearest, because ties go to smaller ids.  Classes
are numbered by their smallest id, and every cut breaks ties by that number.

The share is set for vectors without structure, for which hashing gains
little: with 32 trees, 0.6 of all matches scan about half of the vectors and
find over nine tenths of the true neighbours.  For embeddings with structure a
fixed ``min_matches`` and a share of 0 do.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do vectors whose length is not the most common
one (the smaller of equally common ones).  Null vec_ids take no part.  Rows
alike in id and vector are one.  With fewer candidates than neighbours asked
for, all are returned.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

NEIGHBOURS = 5
TREES = 32
BITS = 32
MIN_MATCHES = 2_000
MATCH_SHARE = 0.6
BUCKET_ROWS = 20_000
QUERY_STEP = 50
#: Bucket prefixes are this much shorter than the length expected to suffice.
SPARE_BITS = 3
_SEED = 20_240_607


def _directions(dim: int, trees: int, bits: int) -> np.ndarray:
    """(dim, trees * bits): orthonormal sets of random directions."""
    rng = np.random.default_rng(_SEED)
    need, sets = trees * bits, []
    while sum(s.shape[1] for s in sets) < need:
        sets.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
    return np.concatenate(sets, axis=1)[:, :need].astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    size = F.size("embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    kept = (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
                   .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
                   .where((size > 0) & finite & nonzero))
    lengths = kept.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.where(size == (lengths["n"] if lengths else 0))


def _vectors(column) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines in double precision."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class Forest:
    """The hash functions and the dealing of one index."""

    def __init__(self, dim: int, n: int, trees: int = TREES, bits: int = BITS,
                 min_matches: int = MIN_MATCHES, match_share: float = MATCH_SHARE):
        self.directions, self.trees, self.bits = _directions(dim, trees, bits), trees, bits
        self.target = max(min_matches, match_share * n)
        self.prefix = min(bits - 1, max(0, int(math.log2(max(1.0, trees * n / self.target))) - SPARE_BITS))
        self.n = n

    def salts(self) -> int:
        """Splits of a bucket (of even buckets; the salt of a row is drawn evenly)."""
        return max(1, -(-self.n // (BUCKET_ROWS << self.prefix)))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): hash strings as integers, first character on top."""
        signs = (x.astype(np.float32) @ self.directions > 0).reshape(len(x), self.trees, self.bits)
        weights = np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return signs.astype(np.int64) @ weights

    def dealt(self, rows: DataFrame, queries: bool, vectors: bool, extra: str = "") -> DataFrame:
        """Rows by (tree, bucket, salt); queries go to every salt.

        ``rows`` has rep, salt0 (drawn in 0 .. 2^31) and embedding, and ``extra`` columns.
        """
        salts, shift = self.salts(), self.bits - self.prefix
        names = [c.split()[0] for c in extra.split(", ")] if extra else []

        def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                x = _vectors(pdf["embedding"])
                codes = self.codes(x / np.abs(x).max(axis=1, keepdims=True))
                raw = [v.tobytes() for v in x] if vectors else [None] * len(x)
                for salt in range(salts if queries else 1):
                    own = np.full(len(x), salt) if queries else pdf["salt0"].to_numpy() % salts
                    out = pd.DataFrame({
                        "tree": np.tile(np.arange(self.trees, dtype=np.int32), len(x)), "bucket": (codes >> shift).ravel(),
                        "salt": np.repeat(own, self.trees), "code": codes.ravel(),
                        "rep": np.repeat(pdf["rep"].to_numpy(), self.trees)})
                    if vectors:
                        out["x"] = [r for r in raw for _ in range(self.trees)]
                    for name in names:
                        out[name] = np.repeat(pdf[name].to_numpy(), self.trees)
                    yield out

        schema = "tree int, bucket long, salt long, code long, rep long" + (", x binary" if vectors else "") + (f", {extra}" if extra else "")
        return rows.mapInPandas(spread, schema)

    def match_counts(self, index: DataFrame, queries: DataFrame) -> DataFrame:
        """(query, level, matches): strings sharing at least ``level`` characters, over all trees."""
        bits, prefix = self.bits, self.prefix

        def count(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(asked):
                return pd.DataFrame({"query": pd.Series([], dtype="int64"), "counts": []})
            codes, q = np.sort(rows["code"].to_numpy()), asked["code"].to_numpy()
            counts = np.empty((len(q), bits - prefix + 1), np.int64)
            for level in range(prefix, bits + 1):
                lo = (q >> (bits - level)) << (bits - level)
                hi = lo + (np.int64(1) << (bits - level))
                counts[:, level - prefix] = np.searchsorted(codes, hi) - np.searchsorted(codes, lo)
            return pd.DataFrame({"query": asked["rep"].to_numpy(), "counts": list(counts)})

        keys = ["tree", "bucket", "salt"]
        found = (self.dealt(index, False, False).groupBy(*keys).cogroup(self.dealt(queries, True, False).groupBy(*keys))
                     .applyInPandas(count, "query long, counts array<long>"))
        return (found.select("query", F.posexplode("counts").alias("l", "c"))
                     .groupBy("query", (F.col("l") + prefix).alias("level")).agg(F.sum("c").alias("matches")))

    def candidates(self, index: DataFrame, queries: DataFrame, best: int) -> DataFrame:
        """(query, rep, score): the ``best`` candidates of each bucket."""
        bits = self.bits

        def score(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            empty = pd.DataFrame({"query": pd.Series([], dtype="int64"), "rep": pd.Series([], dtype="int64"),
                                  "score": pd.Series([], dtype="float64")})
            if not len(rows) or not len(asked):
                return empty
            rows = rows.sort_values("code", kind="stable")
            codes, reps = rows["code"].to_numpy(), rows["rep"].to_numpy()
            x = np.stack([np.frombuffer(b, np.float64) for b in rows["x"]])
            unit = x / np.abs(x).max(axis=1, keepdims=True)
            unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
            # Twice the largest difference of a product of unit rows from the exact cosine.
            slack = 4 * (x.shape[1] + 8) * np.finfo(np.float64).eps
            out = []
            shift = bits - asked["level"].to_numpy(np.int64)
            lo_code = (asked["code"].to_numpy() >> shift) << shift
            lo = np.searchsorted(codes, lo_code)
            hi = np.searchsorted(codes, lo_code + (np.int64(1) << shift))
            ranges = pd.Series(range(len(asked))).groupby([lo, hi]).indices
            for (a, b), members in ranges.items():
                for part in np.array_split(members, -(-len(members) * (b - a) // 4_000_000) or 1) if b > a else ():
                    q = np.stack([np.frombuffer(asked["x"].iloc[i], np.float64) for i in part])
                    qu = q / np.abs(q).max(axis=1, keepdims=True)
                    qu /= np.sqrt((qu * qu).sum(axis=1, keepdims=True))
                    near = qu @ unit[a:b].T
                    # The product preselects: every row that can be among the best, ties included.
                    take = min(b - a, best)
                    least = np.partition(near, b - a - take, axis=1)[:, b - a - take] - slack
                    for j, i in enumerate(part):
                        at = a + np.flatnonzero(near[j] >= least[j])
                        s = _cosines(x[at], np.broadcast_to(q[j], (len(at), q.shape[1])))
                        first = np.lexsort((reps[at], -s))[:best]
                        out.append(pd.DataFrame({"query": asked["rep"].iloc[i], "rep": reps[at][first], "score": s[first]}))
            return pd.concat(out, ignore_index=True) if out else empty

        keys = ["tree", "bucket", "salt"]
        return (self.dealt(index, False, True).groupBy(*keys)
                    .cogroup(self.dealt(queries, True, True, "level int").groupBy(*keys))
                    .applyInPandas(score, "query long, rep long, score double"))


def nearest(vectors: DataFrame, neighbours: int = NEIGHBOURS, query_step: int = QUERY_STEP, trees: int = TREES, bits: int = BITS,
            min_matches: int = MIN_MATCHES, match_share: float = MATCH_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id ``query_step`` divides."""
    members_kept = neighbours + 1
    print_a, print_b = F.xxhash64("embedding"), F.xxhash64("embedding", F.lit(1))
    rows = usable(vectors).select("vec_id", "embedding", print_a.alias("k1"), print_b.alias("k2"))
    same = Window.partitionBy("k1", "k2").orderBy("vec_id")
    classes = stored(rows.dropDuplicates(["vec_id", "k1", "k2"]).withColumn("place", F.row_number().over(same))
                         .where(F.col("place") <= members_kept), "ann-classes")
    spark = vectors.sparkSession
    # Numbers in the order of the classes' smallest ids, so that every cut breaks ties as the result does.
    index = stored(classes.where("place = 1").orderBy("vec_id", "k1", "k2").select(
        F.monotonically_increasing_id().alias("rep"), "embedding", "k1", "k2",
        F.pmod(F.xxhash64("k1"), F.lit(1 << 31)).alias("salt0")), "ann-index")
    n = index.count()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out_schema)
    dim = len(index.select("embedding").first()[0])
    asking = rows.where(F.pmod("vec_id", F.lit(query_step)) == 0).select("vec_id", "k1", "k2").distinct()
    asked = stored(asking.join(index.select("rep", "k1", "k2"), ["k1", "k2"]).select("vec_id", "rep"), "ann-asked")
    points = index.select("rep", "embedding", "salt0")
    open_queries = points.join(asked.select("rep").distinct(), "rep", "left_semi")

    forest = Forest(dim, n, trees, bits, min_matches, match_share)
    found = None
    while True:
        counts = forest.match_counts(points, open_queries)
        # The longest prefix that has enough matches; at the root, whatever there is.
        enough = F.col("matches") >= forest.target
        if not forest.prefix:
            enough = enough | (F.col("level") == 0)
        levels = stored(counts.where(enough).groupBy("query").agg(F.max("level").cast("int").alias("level")), "ann-levels")
        ready = open_queries.join(levels, F.col("rep") == F.col("query")).select("rep", "embedding", "salt0", "level")
        part = stored(forest.candidates(points, ready, members_kept), "ann-candidates")
        found = part if found is None else found.unionAll(part)
        if not forest.prefix:
            break
        open_queries = stored(open_queries.join(levels, F.col("rep") == F.col("query"), "left_anti"), "ann-open")
        if not open_queries.limit(1).count():
            break
        forest.prefix = max(0, forest.prefix - SPARE_BITS)

    # A class's best classes, then their members, then the query's nearest.
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = (found.groupBy("query", "rep").agg(F.max("score").alias("score"))
                 .withColumn("_r", F.dense_rank().over(by_score)).where(F.col("_r") <= members_kept + neighbours))
    named = index.select("rep", "k1", "k2").join(classes.select("vec_id", "k1", "k2"), ["k1", "k2"]).select("rep", "vec_id")
    hits = (asked.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
                 .join(best.select("query", "rep", "score"), "query").join(named, "rep")
                 .where(F.col("vec_id") != F.col("query_id"))
                 .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
