"""Line dedup through a sharded minimal perfect hash.

1. Documents are dealt into batches by a hash of their id.  A batch lists
   each distinct line key once, as a 128-bit hash, with its smallest doc_id
   and whether a second document holds it, so a line found in a third of all
   documents is one row a batch.
2. The batch rows are summed by key.  Keys found in at least two documents go
   to shards by their hash; a shard holds a minimal perfect hash over its
   keys' first 64 bits, and arrays of fingerprints (the other 64 bits),
   document counts and owners (smallest doc_id), indexed by it.
3. Each batch probes the shards' arrays with its distinct keys and gets the
   owners of the repeated ones back.
4. The batch's texts meet these owners and lose the repeated lines that they
   do not own.  No line text is ever shuffled or joined.

Texts are shuffled once, by batch.  Batches hold about ``BATCH_DOCS``
documents and shards about ``SHARD_KEYS`` keys, whatever the input size.

Defined cases: a null or empty text is one empty line, whose key is too short
to drop.  Rows with the same doc_id count as one document, so each keeps the
lines that their id owns; null doc_ids count as one document that sorts first.
An empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import mphf
from .common import ASCII_SPACE

MIN_KEY_CHARS = 10
BATCH_DOCS = 4_000
SHARD_KEYS = 200_000
_SPACE = ASCII_SPACE.decode()
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_NULL_ID = np.iinfo(np.int64).min


def line_key(line: str) -> str:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    line = line.strip(_SPACE)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def key_hash(key: str) -> tuple[int, int]:
    """128-bit hash of a key as two unsigned longs."""
    h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"))
    return h >> 64, h & 0xFFFFFFFFFFFFFFFF


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _batch_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct (batch, key) of the documents seen, with first and last doc_id."""
    for pdf in batches:
        found: dict[tuple[int, int, int], list] = {}
        for batch, doc, text in zip(pdf["batch"], pdf["doc"], pdf["text"]):
            for line in (text or "").split("\n"):
                key = line_key(line)
                if len(key) >= MIN_KEY_CHARS:
                    at = (batch, *key_hash(key))
                    seen = found.get(at)
                    if seen is None:
                        found[at] = [doc, doc]
                    elif doc < seen[0]:
                        seen[0] = doc
                    elif doc > seen[1]:
                        seen[1] = doc
        if found:
            yield pd.DataFrame({
                "batch": [k[0] for k in found], "h1": [_signed(k[1]) for k in found], "h2": [_signed(k[2]) for k in found],
                "first": [v[0] for v in found.values()], "last": [v[1] for v in found.values()]})


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """One index shard: hash function and arrays in its order.

    Keys that share their first 64 bits (not expected) are kept beside the
    arrays, so that the answer is whole in any case.
    """
    pdf = pdf.sort_values(["h1", "h2"])
    extra = pdf[pdf["h1"].duplicated(keep="first")]
    pdf = pdf[~pdf["h1"].duplicated(keep="first")]
    keys = pdf["h1"].to_numpy().view(np.uint64)
    blob = mphf.build(keys)
    slot = mphf.Lookup(blob)(keys)
    arrays = {}
    for column, dtype in (("h2", np.int64), ("owner", np.int64), ("docs", np.int64)):
        a = np.empty(len(keys), dtype)
        a[slot] = pdf[column].to_numpy()
        arrays[column] = a.tobytes()
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "mph": [blob], "prints": [arrays["h2"]],
                         "owners": [arrays["owner"]], "counts": [arrays["docs"]],
                         "rest": [extra[["h1", "h2", "owner"]].to_numpy(np.int64).tobytes()]})


def _probe(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Owners of the asked keys that the shard's arrays hold."""
    empty = pd.DataFrame({"batch": pd.Series([], dtype="int64"), "h1": pd.Series([], dtype="int64"),
                          "h2": pd.Series([], dtype="int64"), "owner": pd.Series([], dtype="int64")})
    if not len(index) or not len(asked):
        return empty
    row = index.iloc[0]
    prints, owners = np.frombuffer(row["prints"], np.int64), np.frombuffer(row["owners"], np.int64)
    h1, h2 = asked["h1"].to_numpy(), asked["h2"].to_numpy()
    slot = mphf.Lookup(row["mph"])(h1.view(np.uint64))
    hit = slot >= 0
    hit[hit] = prints[slot[hit]] == h2[hit]
    out = asked.loc[hit, ["batch", "h1", "h2"]].assign(owner=owners[slot[hit]])
    for a, b, owner in np.frombuffer(row["rest"], np.int64).reshape(-1, 3):
        same = (h1 == a) & (h2 == b)
        out = pd.concat([out, asked.loc[same, ["batch", "h1", "h2"]].assign(owner=owner)])
    return out


def _drop_lines(docs: pd.DataFrame, owners: pd.DataFrame) -> Iterator[tuple]:
    """(row, lines before, dropped, kept text) of a batch's documents."""
    owner = dict(zip(zip(owners["h1"], owners["h2"]), owners["owner"]))
    for row in docs.itertuples(index=False):
        lines = (row.text or "").split("\n")
        kept = []
        for line in lines:
            key = line_key(line)
            if len(key) >= MIN_KEY_CHARS:
                a, b = key_hash(key)
                o = owner.get((_signed(a), _signed(b)))
                if o is not None and o != row.doc:
                    continue
            kept.append(line)
        yield row, len(lines), len(lines) - len(kept), "\n".join(kept)


def build_index(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(batch keys, index shards, number of shards)."""
    keys = stored(docs.mapInPandas(_batch_keys, "batch long, h1 long, h2 long, first long, last long")
                      .groupBy("batch", "h1", "h2").agg(F.min("first").alias("first"), F.max("last").alias("last")), "line-keys")
    repeated = stored(keys.groupBy("h1", "h2")
                          .agg(F.min("first").alias("owner"), F.max("last").alias("last"), F.count("*").alias("docs"))
                          .where("owner < last").drop("last"), "line-repeats")
    n_shards = max(1, -(-repeated.count() // SHARD_KEYS))
    shard = F.pmod("h2", F.lit(n_shards))
    index = (repeated.withColumn("shard", shard).groupBy("shard")
                     .applyInPandas(_build_shard, "shard long, mph binary, prints binary, owners binary, counts binary, rest binary"))
    return keys, stored(index, "line-index"), n_shards


def dedup_lines(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text (or its SHA-256).

    ``digest`` returns ``kept_sha256`` in place of ``text``.
    """
    n_docs = docs.count()
    n_batches = max(1, -(-n_docs // BATCH_DOCS))
    dealt = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(int(_NULL_ID))).alias("doc"), "text",
        F.pmod(F.xxhash64("doc_id"), F.lit(n_batches)).alias("batch"))
    keys, index, n_shards = build_index(dealt.select("batch", "doc", "text"))
    asked = keys.select(F.pmod("h2", F.lit(n_shards)).alias("shard"), "batch", "h1", "h2")
    owners = (index.groupBy("shard").cogroup(asked.groupBy("shard"))
                   .applyInPandas(_probe, "batch long, h1 long, h2 long, owner long"))

    def clean(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = [(row.doc_id, n, dropped, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest() if digest else kept)
               for row, n, dropped, kept in _drop_lines(texts, found)]
        frame = pd.DataFrame(out, columns=["doc_id", "n_lines", "n_dropped", "kept"])
        return frame.astype({"doc_id": "Int64", "n_lines": "int64", "n_dropped": "int64"})

    name = "kept_sha256" if digest else "text"
    return (dealt.groupBy("batch").cogroup(owners.groupBy("batch"))
                 .applyInPandas(clean, "doc_id long, n_lines long, n_dropped long, kept string")
                 .withColumnRenamed("kept", name))
