"""Token-id files with a perfect-hash index.

Writing: documents are range-partitioned and sorted by doc_id; each task cuts
its run of documents into segments of at most ``SEGMENT_IDS`` ids (a longer
document gets a segment of its own).  A segment is one row of a Parquet table,
so files land on any store Spark can write, and commits survive lost
executors.  Columns of a segment:

    shard, seq        place in the order: range partition, segment within it
    first_key, last_key   smallest and largest doc_id inside
    id_bytes          2 or 4, the width of an id
    payload           raw little-endian ids of the documents, back to back
    ends              uint32 end of each document in the payload, in ids
    n_null            leading documents without doc_id
    keys              the distinct doc_ids, ascending (to list a segment; lookups do not read it)
    mph, prints, rows minimal perfect hash over the distinct doc_ids; by its
                      index, the key's 32-bit fingerprint and the first
                      document and number of documents of the key

Reading a key evaluates the hash (a constant number of bit probes), compares
the fingerprint and slices the payload.  Ids are stored as 2 bytes when the
vocabulary allows.

Encoding: the tokenizer's pre-tokenizer cuts a text into pieces that its model
encodes independently.  For texts of the plain alphabet (``_PLAIN``: ASCII
without the apostrophe and control characters, and Latin letters up to U+027F)
the cuts are computed for many texts at once, and each distinct piece is
encoded by the library's model once per worker and kept in a bounded cache of
flat arrays.  Pieces are found by hash and compared byte by byte, with their
like in the batch and with the cached one.  All other texts, and those that hold
the string of an added token, are encoded whole by the library.  Both give the
ids of ``encode(text, add_special_tokens=False)``.

Defined cases: a null or empty text is the end id alone.  Null doc_ids come
first and are reached by position, not by key.  Rows with the same doc_id are
all kept, in the order of their texts' hashes; a key reaches all of them.  An
empty table gives no segments.  Only doc_id and text are read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import mphf
from .common import mix64, text_groups
from .words import span_hashes

END_ID = 0
SEGMENT_IDS = 2_000_000
ROWS_PER_SHARD = 5_000
#: Distinct pieces a worker keeps; the cache starts afresh beyond it.
CACHE_PIECES = 1_000_000
#: Bytes of a piece kept as two words; longer pieces are kept as they are.
_SHORT = 16

SEGMENT_SCHEMA = ("shard int, seq int, first_key long, last_key long, n_docs int, n_ids long, id_bytes int, "
                  "payload binary, ends binary, n_null int, keys binary, mph binary, prints binary, rows binary")

# Byte classes of the plain alphabet: letters, digits, marks, space, newline, other.
_LETTER, _DIGIT, _MARK, _BLANK, _NEWLINE, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[ord("'")] = _OTHER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("A") : ord("Z") + 1] = _LETTER
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[0x80:0xC0] = _LETTER  # continuation bytes
_CLASS[0xC3:0xCA] = _LETTER  # lead bytes of U+00C0 .. U+027F
_CLASS[ord(" ")] = _BLANK
_CLASS[ord("\n")] = _NEWLINE


def _plain(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to the plain alphabet (the signs for times and
    divide, U+00D7 and U+00F7, are not letters)."""
    good = _CLASS[data] != _OTHER
    sign = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    good[:-1] &= ~sign
    return good


def piece_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokenizer's pieces begin in plain texts laid end to end.

    Runs of letters, of digits and of marks are pieces; one blank before a run
    belongs to it; of longer white space the last character is set apart; white
    space that ends a text is one piece.
    """
    kind = _CLASS[data]
    space = kind >= _BLANK
    cut = np.ones(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    before = space[:-1]
    after = space[1:]
    first = np.zeros(len(data) + 1, bool)
    first[text_starts] = True
    first[-1] = True
    # A run after white space: joined to a blank, apart from a newline.
    follows = ~after & before
    cut[1:][follows] = data[:-1][follows] != 0x20
    # Inside white space: only before its last character, when text follows.
    inside = np.flatnonzero(after & before) + 1
    more = np.minimum(inside + 1, len(data) - 1)
    cut[inside] = ~first[inside + 1] & ~space[more]
    cut[first[:-1]] = True
    return np.flatnonzero(cut)


def _heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(pieces, 2): the first 16 bytes of each piece, zeros beyond its end."""
    padded = np.concatenate((data, np.zeros(_SHORT, np.uint8)))
    at = np.lib.stride_tricks.sliding_window_view(padded, _SHORT)[starts]
    at = np.where(np.arange(_SHORT) < (ends - starts)[:, None], at, np.uint8(0))
    return np.ascontiguousarray(at).view(np.uint64)


def _byte_names() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Encoder:
    """A tokenizer file with a worker-wide cache of encoded pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = _byte_names()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._clear()

    def _clear(self) -> None:
        # By hash, ascending: the piece's number.  By number: first bytes, length, ids.
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.heads, self.sizes = np.zeros((1 << 12, 2), np.uint64), np.zeros(1 << 12, np.int64)
        self.start, self.flat = np.zeros((1 << 12) + 1, np.int64), np.empty(1 << 14, np.uint32)
        self.long: dict[int, bytes] = {}
        self.count = 0

    def _add(self, hashes: np.ndarray, heads: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Encode new pieces; their numbers."""
        tokenize, names = self.tokenizer.model.tokenize, self.names
        ids = [[t.id for t in tokenize(p.decode("latin-1").translate(names))] for p in pieces]
        at, end = self.count, self.count + len(pieces)
        if end > len(self.sizes):
            more = max(end, 2 * len(self.sizes))
            self.heads, self.sizes, self.start = (np.concatenate((x, np.zeros((more - len(self.sizes), *x.shape[1:]), x.dtype)))
                                                  for x in (self.heads, self.sizes, self.start))
        self.heads[at:end], self.sizes[at:end] = heads, [len(p) for p in pieces]
        self.start[at + 1 : end + 1] = self.start[at] + np.cumsum([len(i) for i in ids])
        used = int(self.start[end])
        if used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty(max(used, 2 * len(self.flat)) - len(self.flat), np.uint32)))
        self.flat[self.start[at] : used] = np.fromiter((x for i in ids for x in i), np.uint32, used - int(self.start[at]))
        self.long |= {at + k: p for k, p in enumerate(pieces) if len(p) > _SHORT}
        own = np.arange(at, end, dtype=np.int32)
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.numbers = np.insert(self.hashes, place, hashes), np.insert(self.numbers, place, own)
        self.count = end
        return own

    def _encode_plain(self, texts: list[bytes]) -> list[np.ndarray] | None:
        """Ids of plain texts; None if two different pieces have one hash."""
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        lengths = np.array([len(t) for t in texts])
        begins = np.cumsum(lengths) - lengths
        starts = piece_starts(data, begins)
        ends = np.append(starts[1:], len(data))
        sizes, heads = ends - starts, _heads(data, starts, ends)
        distinct, example, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        like = example[inverse]
        if (heads != heads[like]).any() or (sizes != sizes[like]).any():
            return None
        cut = lambda i: raw[starts[i] : ends[i]]
        if any(cut(i) != cut(like[i]) for i in np.flatnonzero(sizes > _SHORT)):
            return None
        if self.count + len(distinct) > CACHE_PIECES:
            self._clear()
        place = np.searchsorted(self.hashes, distinct)
        hit = place < len(self.hashes)
        hit[hit] = self.hashes[place[hit]] == distinct[hit]
        number = np.empty(len(distinct), np.int64)
        number[hit] = self.numbers[place[hit]]
        known, own = number[hit], example[hit]
        if (self.heads[known] != heads[own]).any() or (self.sizes[known] != sizes[own]).any():
            return None
        if any(self.long[n] != cut(i) for n, i in zip(known[sizes[own] > _SHORT].tolist(), own[sizes[own] > _SHORT].tolist())):
            return None
        new = np.flatnonzero(~hit)
        if len(new):
            number[new] = self._add(distinct[new], heads[example[new]], [cut(i) for i in example[new].tolist()])
        piece = number[inverse]
        count = self.start[piece + 1] - self.start[piece]
        upto = np.cumsum(count)
        ids = self.flat[np.repeat(self.start[piece] - (upto - count), count) + np.arange(upto[-1])]
        # Ids before each text: those of the pieces before its first piece.
        bounds = np.concatenate(([0], upto))[np.searchsorted(starts, begins)]
        return np.split(ids, bounds[1:])

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text (none for a null or empty one)."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for first, group in text_groups(texts):
            plain = []
            for i, t in enumerate(group):
                if not t:
                    continue
                if _plain(np.frombuffer(t, np.uint8)).all() and not any(a in t for a in self.added):
                    plain.append(i)
                else:
                    out[first + i] = self._whole(texts[first + i])
            if plain:
                found = self._encode_plain([group[i] for i in plain]) or [self._whole(texts[first + i]) for i in plain]
                for i, ids in zip(plain, found):
                    out[first + i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def _segment(shard: int, seq: int, keys: list, docs: list[np.ndarray], width: int) -> dict:
    ends = np.cumsum([len(d) for d in docs])
    ids = np.concatenate(docs)
    n_null = sum(k is None for k in keys)
    own = np.array(keys[n_null:], np.int64)
    distinct, first, count = np.unique(own, return_index=True, return_counts=True)
    mph = mphf.build(distinct.view(np.uint64))
    slot = mphf.Lookup(mph)(distinct.view(np.uint64))
    prints = np.empty(len(distinct), np.uint32)
    rows = np.empty((len(distinct), 2), np.uint32)
    prints[slot] = _fingerprints(distinct.view(np.uint64))
    rows[slot] = np.stack((first + n_null, count), axis=1)
    return {
        "shard": shard, "seq": seq, "first_key": int(own[0]) if len(own) else None,
        "last_key": int(own[-1]) if len(own) else None, "n_docs": len(docs), "n_ids": int(ends[-1]), "id_bytes": width,
        "payload": ids.astype(f"<u{width}").tobytes(), "ends": ends.astype("<u4").tobytes(), "n_null": n_null,
        "keys": distinct.tobytes(), "mph": mph, "prints": prints.tobytes(), "rows": rows.tobytes()}


class Segment:
    """Keyed access to a segment row."""

    def __init__(self, row):
        self.ids = np.frombuffer(row["payload"], f"<u{row['id_bytes']}")
        self.ends = np.frombuffer(row["ends"], "<u4").astype(np.int64)
        self.n_null = int(row["n_null"])
        self.lookup = mphf.Lookup(row["mph"])
        self.prints = np.frombuffer(row["prints"], np.uint32)
        self.rows = np.frombuffer(row["rows"], np.uint32).reshape(-1, 2).astype(np.int64)

    def document(self, i: int) -> tuple[int, np.ndarray]:
        """Start and ids of the i-th document."""
        start = int(self.ends[i - 1]) if i else 0
        return start, self.ids[start : self.ends[i]]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First document and number of documents of each key; 0 of them if absent."""
        keys = np.asarray(keys, np.int64).view(np.uint64)
        slot = self.lookup(keys)
        out = np.zeros((len(keys), 2), np.int64)
        hit = slot >= 0
        hit[hit] = self.prints[slot[hit]] == _fingerprints(keys[hit])
        out[hit] = self.rows[slot[hit]]
        return out


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the segment table to ``path``."""
    n = max(1, -(-docs.count() // ROWS_PER_SHARD))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_h")]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        tail = np.array([end_id], np.uint32)
        keys, waiting, size = [], [], 0
        for pdf in batches:
            for key, ids in zip(pdf["doc_id"], enc.encode(list(pdf["text"]))):
                if waiting and size + len(ids) + 1 > SEGMENT_IDS:
                    yield pd.DataFrame([_segment(shard, seq, keys, waiting, enc.width)])
                    keys, waiting, size, seq = [], [], 0, seq + 1
                keys.append(None if pd.isna(key) else int(key))
                waiting.append(np.concatenate((ids, tail)))
                size += len(ids) + 1
        if waiting:
            yield pd.DataFrame([_segment(shard, seq, keys, waiting, enc.width)])

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
         .repartitionByRange(n, *order).sortWithinPartitions(*order)
         # As text: a long with nulls would reach pandas as a float.
         .select(F.col("doc_id").cast("string").alias("doc_id"), "text")
         .mapInPandas(encode, SEGMENT_SCHEMA)
         .write.option("compression", "zstd").parquet(path))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The written segment table."""
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, seq, base): ids of all segments before each one."""
    sums = segments(spark, path).select("shard", "seq", "n_ids")
    within = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sums.groupBy("shard").agg(F.sum("n_ids").alias("t"))
    before = shards.select("shard", F.coalesce(F.sum("t").over(whole), F.lit(0)).alias("b"))
    return (sums.select("shard", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("w"))
                .join(before, "shard").select("shard", "seq", (F.col("b") + F.col("w")).cast("long").alias("base")))


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Place, length and CRC of every document, reached through the index."""
    for pdf in batches:
        for _, row in pdf.iterrows():
            seg = Segment(row)
            keys = np.frombuffer(row["keys"], np.int64)
            found = seg.find(keys)
            reached = np.concatenate([np.arange(seg.n_null), *(np.arange(a, a + c) for a, c in found)])
            if not np.array_equal(reached, np.arange(len(seg.ends))):
                raise ValueError("the index does not reach every document")
            owner = [None] * seg.n_null + np.repeat(keys, found[:, 1]).tolist()
            out = []
            for i, key in enumerate(owner):
                at, ids = seg.document(i)
                out.append((key, row["shard"], row["seq"], at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "shard", "seq", "at", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    rows = segments(spark, path).mapInPandas(
        _digest, "doc_id long, shard int, seq int, at long, n_tokens long, ids_crc32 long")
    return (rows.join(segment_starts(spark, path), ["shard", "seq"])
                .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def read_ids(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, ids of the documents of ``keys`` (a doc_id column).

    The driver holds first and last key of each segment, two numbers for
    ``SEGMENT_IDS`` ids; a key goes to the segments whose range holds it.
    """
    meta = [r for r in segments(spark, path).where("first_key IS NOT NULL")
            .select("first_key", "last_key", "shard", "seq").orderBy("shard", "seq").collect()]
    first, last = np.array([r[0] for r in meta], np.int64), np.array([r[1] for r in meta], np.int64)

    @F.pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        return pd.Series([list(range(a, b)) for a, b in zip(np.searchsorted(last, k, "left"), np.searchsorted(first, k, "right"))])

    def fetch(seg_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(seg_rows) and len(asked):
            seg = Segment(seg_rows.iloc[0])
            wanted = asked["doc_id"].to_numpy(np.int64)
            for key, (a, c) in zip(wanted.tolist(), seg.find(wanted).tolist()):
                out += [(key, seg.document(i)[1].astype(np.int64)) for i in range(a, a + c)]
        return pd.DataFrame(out, columns=["doc_id", "ids"])

    place = spark.createDataFrame([(i, r[2], r[3]) for i, r in enumerate(meta)], "place int, shard int, seq int")
    asked = (keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
                 .withColumn("place", F.explode(places("doc_id"))).join(F.broadcast(place), "place"))
    return (segments(spark, path).groupBy("shard", "seq").cogroup(asked.groupBy("shard", "seq"))
            .applyInPandas(fetch, "doc_id long, ids array<long>"))


def encode_digest(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex[:12]}"
    write_ids(docs, path, tokenizer, end_id)
    return digest(spark, path)
