"""SimHash near duplicates by a self-join of a binary trie.

A text's fingerprint has bit b set if more than half of the 64-bit hashes of
its ``WIDTH``-word shingles (repeats included) have it set.  Two fingerprints
are linked if they differ in at most ``BUDGET`` bits.  Texts with equal
fingerprints are one class, so only distinct fingerprints are joined.

The distinct fingerprints form a binary trie.  The join starts at the pair
(root, root) and goes down in pairs of nodes of equal depth: a child pair adds
a differing bit where the children's bits differ, and a pair with more
differing bits than the budget is pruned with everything below it.

* The upper levels are DataFrame joins of the pair table with the node table
  (prefix, number of fingerprints), ``DIGIT`` bits a step.  A pair is a unit of
  work as soon as both nodes hold at most ``NODE_ROWS`` fingerprints, so
  crowded prefixes go deeper than sparse ones and nothing is collected.
* A unit's two nodes meet in one task, which goes down their tries level by
  level on sorted arrays, the whole frontier of node pairs at once, to pairs of
  a few fingerprints.  Its links are reduced to a spanning forest before they
  leave the task, so a group of n linked fingerprints gives at most n - 1 rows
  a unit, not n^2.

Components are computed over fingerprints and named by the smallest id.

Defined cases: null, empty and blank texts have no shingle and the fingerprint
zero, which links like any other.  Texts under ``WIDTH`` words have one shingle,
their whole word sequence.  Texts of any length are hashed whole.  Rows with a
null doc_id take part; a component is named by its smallest non-null id, or
null if it has none.  Repeated rows come back as often as they are given.  An
empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components

WIDTH = 3
SEED = 42
BUDGET = 3
#: Fingerprints of a trie node from which on a node pair is left to one task.
NODE_ROWS = 16_384
#: Bits that one step of the upper levels goes down.
DIGIT = 3
#: Shingles whose bits are counted at once, and node pairs expanded at once.
CHUNK = 1 << 16
FRONTIER = 1 << 20


def fingerprint_of(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII white space and A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], ends[: k - 1] + 1)).tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, k, CHUNK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[a : a + CHUNK], ends[a : a + CHUNK])], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > k).tobytes(), "big")


def fingerprint(text: Column, width: int = WIDTH, seed: int = SEED) -> Column:
    """The fingerprint as a signed long (the same 64 bits)."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        out = np.array([fingerprint_of(t, width, seed) for t in texts], np.uint64)
        return pd.Series(out.view(np.int64))

    return run(text)


def _reduced(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (each node's root or a smaller node of its group) with the
    groups of linked nodes i, j merged."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def trie_links(a: np.ndarray, b: np.ndarray, budget: int = BUDGET, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct uint64 arrays ``a`` and ``b`` that differ
    in at most ``budget`` bits; with ``same`` (b is a) each pair once."""

    def ones_before(x: np.ndarray) -> list[np.ndarray]:
        made: list[np.ndarray] = []

        def level(t: int) -> np.ndarray:
            while len(made) <= t:
                bit = (x >> np.uint64(63 - len(made))) & np.uint64(1)
                made.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            return made[t]

        return level

    ones_a = ones_before(a)
    ones_b = ones_a if same else ones_before(b)
    one = lambda v: np.array([v], np.int32)
    stack = [(0, one(0), one(len(a)), one(0), one(len(b)), np.zeros(1, np.int8))] if len(a) and len(b) else []
    while stack:
        t, al, ah, bl, bh, d = stack.pop()
        if len(al) > FRONTIER:
            for part in np.array_split(np.arange(len(al)), -(-len(al) // FRONTIER)):
                stack.append((t, al[part], ah[part], bl[part], bh[part], d[part]))
            continue
        # Pairs of few fingerprints are compared; bit 64 does not exist.
        na, nb = ah - al, bh - bl
        small = na.astype(np.int64) * nb <= 16 if t < 64 else np.ones(len(al), bool)
        if small.any():
            n = (na[small].astype(np.int64) * nb[small])
            first = np.repeat(np.cumsum(n) - n, n)
            k, width = np.arange(n.sum()) - first, np.repeat(nb[small], n)
            i, j = np.repeat(al[small], n) + k // width, np.repeat(bl[small], n) + k % width
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            rest = ~small
            al, ah, bl, bh, d = al[rest], ah[rest], bl[rest], bh[rest], d[rest]
        if not len(al):
            continue
        ca, cb = ones_a(t), ones_b(t)
        am, bm = ah - (ca[ah] - ca[al]), bh - (cb[bh] - cb[bl])  # first fingerprint with a one at bit t
        twin = (al == bl) if same else np.zeros(len(al), bool)
        a0, a1, b0, b1, left = am > al, ah > am, bm > bl, bh > bm, d < budget
        parts = [(a0 & b0, al, am, bl, bm, 0), (a1 & b1, am, ah, bm, bh, 0), (a0 & b1 & left, al, am, bm, bh, 1),
                 (a1 & b0 & left & ~twin, am, ah, bl, bm, 1)]
        stack.append((t + 1, *(np.concatenate([p[c][p[0]] for p in parts]) for c in range(1, 5)),
                      np.concatenate([d[p[0]] + np.int8(p[5]) for p in parts])))


def _unit_links(budget: int):
    """Spanning links of one unit: a row (side, fps) for each of its one or two nodes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = [np.sort(np.asarray(fps, np.int64).view(np.uint64)) for fps in pdf.sort_values("side")["fps"]]
        a, same = nodes[0], len(nodes) == 1
        b = None if same else nodes[1]
        both = a if same else np.concatenate((a, b))
        label = np.arange(len(both))
        for i, j in trie_links(a, a if same else b, budget, same):
            label = _reduced(label, i, j if same else j + len(a))
        k = np.flatnonzero(label != np.arange(len(both)))
        return pd.DataFrame({"a": both[label[k]].view(np.int64), "b": both[k].view(np.int64)})

    return run


def _prefix(fp: Column, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits) if bits else F.lit(0).cast("long")


def node_pairs(fps: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """Units of work (a, b, bits): trie nodes, as prefixes of ``bits`` bits,
    whose fingerprints may be linked and are few enough for one task.

    ``fps`` has distinct fingerprints ``fp``.  A node at the last bit holds one
    fingerprint, so every branch ends.
    """
    bits, units = 0, []
    nodes = fps.groupBy(_prefix(F.col("fp"), 0).alias("p")).count()
    pairs = stored(nodes.select(F.col("p").alias("a"), F.col("p").alias("b"), F.col("count").alias("na"), F.col("count").alias("nb")), "simhash-pairs")
    small = (F.col("na") <= node_rows) & (F.col("nb") <= node_rows)
    while True:
        units.append(pairs.where(small).select("a", "b", F.lit(bits).alias("bits")))
        if bits >= 64 or pairs.where(~small).isEmpty():
            return reduce(DataFrame.unionAll, units)
        step = min(DIGIT, 64 - bits)
        bits += step
        nodes = fps.groupBy(_prefix(F.col("fp"), bits).alias("p")).count()
        child = lambda up, c, n: nodes.select(F.shiftrightunsigned("p", step).alias(up), F.col("p").alias(c), F.col("count").alias(n))
        pairs = stored(
            pairs.where(~small).select(F.col("a").alias("ua"), F.col("b").alias("ub"))
                 .join(child("ua", "a", "na"), "ua").join(child("ub", "b", "nb"), "ub")
                 .where(((F.col("ua") != F.col("ub")) | (F.col("a") <= F.col("b")))
                        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= budget))
                 .select("a", "b", "na", "nb"), "simhash-pairs")


def links(fps: DataFrame, budget: int = BUDGET, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): links that join the distinct fingerprints ``fp`` of ``fps`` into
    the components that all links within ``budget`` bits make."""
    units = stored(node_pairs(fps, budget, node_rows).withColumn("unit", F.monotonically_increasing_id()), "simhash-units")
    depths = [r["bits"] for r in units.select("bits").distinct().orderBy("bits").collect()]  # at most 64 / DIGIT + 1
    if not depths:
        return units.select("a", "b").where("false")
    sides = units.select("unit", "bits", F.explode(F.expr(
        "CASE WHEN a = b THEN array(named_struct('side', 0, 'node', a)) "
        "ELSE array(named_struct('side', 0, 'node', a), named_struct('side', 1, 'node', b)) END")).alias("s")).select("unit", "bits", "s.*")
    placed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(d).alias("bits"), _prefix(F.col("fp"), d).alias("node")) for d in depths]))
                        .alias("n")).select("fp", "n.*")
    # The nodes of units have at most node_rows fingerprints, so a node fits into a row, which then goes to its units.
    nodes = (placed.join(sides.select("bits", "node").distinct(), ["bits", "node"], "left_semi")
                   .groupBy("bits", "node").agg(F.collect_list("fp").alias("fps")))
    rows = sides.join(nodes, ["bits", "node"]).select("unit", "side", "fps")
    return rows.groupBy("unit").applyInPandas(_unit_links(budget), "a long, b long")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, width: int = WIDTH, node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row of ``docs``."""
    rows = stored(docs.select("doc_id", fingerprint(F.col("text"), width).alias("fp")), "simhash-rows")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    edges = stored(links(classes.select("fp"), budget, node_rows), "simhash-links")
    groups = components(edges).withColumnRenamed("id", "fp")
    members = groups.join(classes, "fp")
    named = members.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = (classes.join(groups, "fp", "left").join(named, "component", "left")
                       .select("fp", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id")))
    return rows.join(of_class, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
