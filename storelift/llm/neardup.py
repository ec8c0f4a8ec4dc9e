"""Near-duplicate documents by a signature-coordinate inverted join.

1. Each document's distinct five-word shingles give its size, a 128-bit digest
   of the set and a MinHash signature of ``COORDINATES`` values.  Documents
   with equal sets form one class, represented by the smallest doc_id; only
   representatives go on.
2. Every representative is posted under each (coordinate, value) pair.  A pair
   of sets with similarity 0.75 agrees in 48 of 64 coordinates on average; a
   candidate must agree in at least ``MATCHES`` = 32, which such a pair misses
   with probability about 1e-6.
3. Prefix: with postings in one global order, rarest list first, two documents
   agreeing in 32 of 64 coordinates share a list among the first 33 of both.
   Only those are merged; the longest lists, as of a passage that many
   documents hold, are skipped, and the full signatures give the count of
   collisions afterwards.
4. Merging a list compares every member to one center, not all pairs.  The
   center is the member whose lists are longest in sum, the one nearest to the
   others.  Links to centers are confirmed on the full sets.
5. What is left are pairs in different components.  Members compared with the
   same center c are checked through their differences from it: with D(x) the
   shingles in which x and c differ, |x and y| follows from |D(x) and D(y)|, so
   a center's members are settled by short arrays, block against block, and
   only links come out.  Of two members in different components one is not
   linked to c; the triangle inequality rules out most partners by size alone.
6. Members too far from their list's center to be compared with its set are
   compared by signature with the list's other members, block against block,
   and pairs with enough collisions are confirmed on their sets.

A link is confirmed on the full shingle sets of both documents:
100 * |A and B| >= 75 * |A or B|.  Sizes are compared before signatures
(similar sets have similar sizes) and signatures before sets.  A large group of
copies costs rows in proportion to its size; no step emits a group's pairs.

Defined cases: null, empty and blank texts have no shingles and are linked
with nothing (component: their own id, kept).  A text of one to four words is
one shingle.  Rows with the same doc_id are one node (its links are those of one
of its texts).  A row with a null doc_id has its set's size; if its set is that of
a row with an id, it has that row's component and is not kept, else it has no
component and is kept.  An empty table gives an empty result.  Only doc_id and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import mix64, text_groups, to_long
from .components import components
from .words import shingle_hashes, word_hashes

SHINGLE = 5
COORDINATES = 64
MATCHES = 32
PREFIX = COORDINATES - MATCHES + 1
#: Rows of a block, and how many bundles of blocks there are for each shuffle partition.
BLOCK, BUNDLES = 2_048, 4
#: Similarity threshold as a fraction of whole numbers.
NUMERATOR, DENOMINATOR = 75, 100

# Odd multipliers, one a coordinate.
_FACTORS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _shingles(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for begin, group in text_groups(texts):
        words, first = word_hashes(group)
        yield begin, *shingle_hashes(words, first, SHINGLE)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Set size, set digest and signature of each document."""
    for pdf in batches:
        for begin, shingles, at in _shingles(list(pdf["text"])):
            n = len(at) - 1
            some = np.flatnonzero(np.diff(at) > 0)
            size = np.zeros(n, np.int64)
            digest = np.zeros((n, 2), np.uint64)
            for i in some:
                own = np.unique(shingles[at[i] : at[i + 1]])
                size[i] = len(own)
                digest[i] = own.sum(), mix64(own).sum()
            signature = np.zeros((n, COORDINATES), np.uint32)
            if len(some):
                for c, factor in enumerate(_FACTORS):
                    signature[some, c] = np.minimum.reduceat(shingles * factor, at[some]) >> np.uint64(32)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].iloc[begin : begin + n].to_numpy(), "n": size,
                "d1": to_long(digest[:, 0].copy()), "d2": to_long(digest[:, 1].copy()),
                "signature": list(signature.view(np.int32))})


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, d1, d2, signature of each document with an id."""
    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        _sketch, "doc_id long, n long, d1 long, d2 long, signature array<int>")


def prefix_postings(reps: DataFrame) -> DataFrame:
    """(key, rep, n, weight): the rarest ``PREFIX`` postings of each
    representative, without the lists that only one of them is on.

    ``weight`` is the summed length of all its lists."""
    posted = reps.select("rep", "n", F.posexplode("signature").alias("c", "v")).select(
        "rep", "n", F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    length = posted.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    shared = (posted.join(length, "key").groupBy("rep", "n")
                    .agg(F.collect_list(F.struct("f", "key")).alias("lists"), F.sum("f").alias("weight")))
    # Lists with one member come first in the order and take up prefix places.
    places = F.lit(PREFIX - COORDINATES) + F.size("lists")
    return (shared.where(places > 0)
                  .select("rep", "n", "weight", F.explode(F.slice(F.array_sort("lists"), F.lit(1), places)).alias("p"))
                  .select(F.col("p.key").alias("key"), "rep", "n", "weight"))


def _sizes_fit(a: Column, b: Column) -> Column:
    return F.lit(DENOMINATOR) * F.least(a, b) >= F.lit(NUMERATOR) * F.greatest(a, b)


def matching(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least ``MATCHES`` places."""
    sig = reps.select("rep", "signature")
    joined = (pairs.join(sig.select(F.col("rep").alias("a"), F.col("signature").alias("sa")), "a")
                   .join(sig.select(F.col("rep").alias("b"), F.col("signature").alias("sb")), "b"))

    @F.pandas_udf("int")
    def agree(sa: pd.Series, sb: pd.Series) -> pd.Series:
        if not len(sa):
            return pd.Series([], dtype="int32")
        return pd.Series((np.stack(list(sa)) == np.stack(list(sb))).sum(axis=1).astype(np.int32))

    return joined.where(agree("sa", "sb") >= MATCHES).select("a", "b")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles): the sorted distinct shingle hashes of the documents in ``ids``.

    The texts are shuffled to the ids at every size; left to Spark, a small
    input would broadcast the ids and hide what a large one costs."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for begin, shingles, at in _shingles(list(pdf["text"])):
                n = len(at) - 1
                yield pd.DataFrame({"id": pdf["doc_id"].iloc[begin : begin + n].to_numpy(),
                                    "shingles": [np.unique(shingles[at[i] : at[i + 1]]).tobytes() for i in range(n)]})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                .join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")
                .mapInPandas(sets, "id long, shingles binary").dropDuplicates(["id"]))


def compared(pairs: DataFrame, docs: DataFrame, tag: str) -> DataFrame:
    """(a, b, linked, nb, d): the pairs compared on their full sets; ``d`` is
    the difference D(b) from a, shingles only in b as they are and shingles only
    in a in another hash."""
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    sets = stored(full_sets(docs, ids), f"{tag}-sets")
    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b")
                   .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a"))

    @F.pandas_udf("linked boolean, nb long, d binary")
    def compare(xa: pd.Series, xb: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(xa, xb):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            more, less = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
            both = len(y) - len(more)
            linked = DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)
            out.append((linked, len(y), np.concatenate((more, mix64(~less))).tobytes()))
        return pd.DataFrame(out, columns=["linked", "nb", "d"])

    return joined.select("a", "b", compare("xa", "xb").alias("r")).select("a", "b", "r.linked", "r.nb", "r.d")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """Rows of each ``group`` in blocks of at most about ``BLOCK``, every block
    set against every block that holds open rows; in ``bundle``s for few, even tasks.

    ``rows`` has the group's column, ``rep`` and ``open`` (the rows that need
    partners).  Returns the columns of ``rows`` with bundle, ub, yb and side
    ("u" the open rows, "y" all)."""
    parts = rows.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.max("open").alias("some")).where("some")
    dealt = rows.join(parts.drop("some"), group).withColumn("own", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    u = dealt.where("open").withColumn("yb", other).withColumnRenamed("own", "ub").withColumn("side", F.lit("u"))
    y = dealt.withColumn("ub", other).withColumnRenamed("own", "yb").withColumn("side", F.lit("y"))
    both = u.drop("parts").unionByName(y.drop("parts"))
    bundles = BUNDLES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.withColumn("bundle", F.pmod(F.xxhash64(group, "ub", "yb"), F.lit(bundles)))


def links_by_difference(stars: DataFrame, part: DataFrame) -> DataFrame:
    """(a, b): links between members of one center that are in different
    components, from their differences to the center.

    ``stars`` are compared pairs (a: center, b: member)."""
    comp = part.select(F.col("id"), "component")
    rows = (stars.join(comp.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
                 .join(comp.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
                 .select(F.col("a").alias("center"), F.col("b").alias("rep"), "nb", "d",
                         F.coalesce("cb", "b").alias("component"),
                         (F.coalesce("ca", "a") != F.coalesce("cb", "b")).alias("open")))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, own in pdf.groupby(["center", "ub", "yb"], sort=False):
            side = own["side"].to_numpy() == "u"
            u, y = own[side], own[~side]
            if not len(u) or len(y) < 2:
                continue
            found += _difference_links(u, y)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return _blocks(rows, "center").groupBy("bundle").applyInPandas(settle, "a long, b long").distinct()


def _difference_links(u: pd.DataFrame, y: pd.DataFrame) -> list[tuple[int, int]]:
    """Links between open members ``u`` and members ``y`` of one center."""
    du = [np.frombuffer(d, np.uint64) for d in u["d"]]
    dy = [np.frombuffer(d, np.uint64) for d in y["d"]]
    nu, ny = u["nb"].to_numpy()[:, None], y["nb"].to_numpy()[None, :]
    su, sy = np.array([len(d) for d in du])[:, None], np.array([len(d) for d in dy])[None, :]
    # |x and y| from the sizes and |D(x) and D(y)| (at most the smaller difference).
    need = lambda shared: DENOMINATOR * (nu + ny - (su + sy - 2 * shared)) >= NUMERATOR * (nu + ny + (su + sy - 2 * shared))
    might = (u["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :]) & need(np.minimum(su, sy))
    rows, cols = might.any(axis=1), might.any(axis=0)
    if not rows.any():
        return []
    # Shared elements, counted over those that both sides have.
    eu, ey = np.concatenate(du + [np.empty(0, np.uint64)]), np.concatenate(dy + [np.empty(0, np.uint64)])
    shared = np.zeros(might.shape, np.int32)
    common = np.intersect1d(eu, ey)
    if len(common):
        ou, oy = np.repeat(np.arange(len(du)), su[:, 0]), np.repeat(np.arange(len(dy)), sy[0])
        for start in range(0, len(common), 4096):
            part = common[start : start + 4096]
            mu, my = np.zeros((len(du), len(part)), np.float32), np.zeros((len(dy), len(part)), np.float32)
            for e, o, m in ((eu, ou, mu), (ey, oy, my)):
                at = np.minimum(np.searchsorted(part, e), len(part) - 1)
                hit = part[at] == e
                m[o[hit], at[hit]] = 1
            shared += (mu @ my.T).astype(np.int32)
    i, j = np.nonzero(might & need(shared))
    a, b = u["rep"].to_numpy()[i], y["rep"].to_numpy()[j]
    return list({(int(min(p)), int(max(p))) for p in zip(a, b)})


def far_pairs(postings: DataFrame, stars: DataFrame, part: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b): pairs on one list, in different components, of which one was
    never compared with the list's center, and whose signatures agree enough.

    A pair comes out of the first of its common lists only."""
    lists = _centers(postings)
    comp = part.withColumnRenamed("id", "rep")
    placed = (postings.join(lists, "key").join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
                      .join(stars.select(F.col("a").alias("center"), F.col("b").alias("rep"), F.lit(True).alias("met")), ["center", "rep"], "left")
                      .withColumn("open", F.col("met").isNull() & (F.col("rep") != F.col("center"))))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("open").alias("o"))
    rows = placed.join(several.where("o AND lo < hi").select("key"), "key", "left_semi").select("key", "rep", "n", "component", "open")
    # The coordinates of a representative's prefix lists, as bits.
    mask = postings.groupBy("rep").agg(F.expr("bit_or(shiftleft(1L, CAST(shiftright(key, 32) AS INT))) AS mask"))
    rows = rows.join(mask, "rep").join(reps.select("rep", "signature"), "rep")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (key, _, _), own in pdf.groupby(["key", "ub", "yb"], sort=False):
            side = own["side"].to_numpy() == "u"
            u, y = own[side], own[~side]
            if not len(u) or not len(y):
                continue
            su, sy = np.stack(list(u["signature"])), np.stack(list(y["signature"]))
            mu, my = u["mask"].to_numpy().view(np.uint64), y["mask"].to_numpy().view(np.uint64)
            earlier = np.uint64((1 << (int(key) >> 32)) - 1)
            nu, ny = u["n"].to_numpy(), y["n"].to_numpy()
            cu, cy = u["component"].to_numpy(), y["component"].to_numpy()
            ru, ry, open_y = u["rep"].to_numpy(), y["rep"].to_numpy(), y["open"].to_numpy()
            for i in range(len(u)):
                might = (cy != cu[i]) & (DENOMINATOR * np.minimum(ny, nu[i]) >= NUMERATOR * np.maximum(ny, nu[i]))
                might &= ~open_y | (ry > ru[i])  # two open ones meet once
                j = np.flatnonzero(might)
                if not len(j):
                    continue
                same = sy[j] == su[i]
                ok = same.sum(axis=1) >= MATCHES
                for p, s in zip(j[ok], same[ok]):
                    bits = np.uint64(int(np.packbits(s, bitorder="little").view(np.uint64)[0]))
                    if not bits & mu[i] & my[p] & earlier:
                        found.append((int(min(ru[i], ry[p])), int(max(ru[i], ry[p]))))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return _blocks(rows, "key").groupBy("bundle").applyInPandas(meet, "a long, b long").distinct()


def _centers(postings: DataFrame) -> DataFrame:
    """(key, center, cn): the member of each list with the longest lists, ties
    to the smaller id."""
    best = postings.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("r"), F.col("n").alias("cn"))).alias("c"))
    return best.select("key", (-F.col("c.r")).alias("center"), F.col("c.cn").alias("cn"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    docs = docs.select("doc_id", "text")
    sketch = stored(sketches(docs), "dup-sketch")
    reps = stored(sketch.where("n > 0").groupBy("n", "d1", "d2")
                        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "dup-reps")
    postings = stored(prefix_postings(reps), "dup-postings")

    near = (postings.join(_centers(postings), "key").where("center <> rep").where(_sizes_fit(F.col("cn"), F.col("n")))
                    .select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct())
    stars = stored(compared(stored(matching(near, reps), "dup-likely"), docs, "dup-star"), "dup-stars")
    links = stars.where("linked").select("a", "b")
    part = components(links)

    by_center = stored(links_by_difference(stars, part), "dup-by-center")
    far = stored(far_pairs(postings, stars, part, reps), "dup-far")
    if far.limit(1).count():
        by_center = by_center.unionAll(stored(compared(far, docs, "dup-far").where("linked").select("a", "b"), "dup-far-links"))
    if by_center.limit(1).count():
        part = components(links.unionAll(by_center))

    classes = (reps.join(part.withColumnRenamed("id", "rep"), "rep", "left")
                   .select("n", "d1", "d2", F.coalesce("component", "rep").alias("component")))
    found = sketch.select("doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    # Rows without an id have no node of their own: their sets are looked up among the classes.
    nameless = docs.where("doc_id IS NULL").select(F.lit(0).cast("long").alias("doc_id"), "text").mapInPandas(
        _sketch, "doc_id long, n long, d1 long, d2 long, signature array<int>").select("n", "d1", "d2")
    unnamed = nameless.join(classes, ["n", "d1", "d2"], "left").select(
        F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("component").isNull().alias("kept"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionAll(unnamed)


def unique_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that repeat an earlier document (rows
    without an id all stay)."""
    gone = near_duplicates(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
