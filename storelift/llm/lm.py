"""Language-model scoring with a gated recurrent network.

Vocabulary and output.  Every word of the training documents is counted.  The
``HEAD`` most frequent ones are words of their own, in classes of
``CLASS_WORDS`` by falling frequency; every other word, known or not, belongs to
one of ``TAIL`` classes by its last letters.  The output softmax is factored:
P(word) = P(class | state) * P(word | class, state) for head words, and
P(class | state) * (c + 1) / (N + V + 1) over the class's training tokens N and
distinct words V for the others, which leaves one share for unknown words.
Probabilities add up to one over the training vocabulary and "unknown".

Blocks.  Texts are tokenised once, into blocks of about ``BLOCK_BYTES`` of text
(a longer document is a block of its own) stored in the shared folder: the
block's distinct word hashes, and (packed) each token's place among them.  Counting,
training and scoring read the blocks.

Network.  One gated recurrent layer reads the class (tail) or word (head) of the
previous token.  Output biases start at the corpus frequencies.  Every training
document is learned from its first token to its last, once: window by window,
with gradients truncated at the window and the state carried into the next one.
Up to ``TRAIN_ROWS`` documents run side by side, a few long ones of those at hand
first; where one ends, the next takes its row with an empty state.  A window has
``WINDOW`` steps, and more while few documents run (up to ``LONG_WINDOW``), so
that it holds about as many tokens.  Tasks train in parallel on their own
documents, about ``TASK_TOKENS`` tokens each, and their weights are averaged by the
number of tokens (in groups of ``AVERAGED`` until few are left), in ``ROUNDS``
rounds of which each takes another part of the documents.  Training work grows
with the number of tokens.  How blocks fall to tasks depends on the cluster's
partitions, and scores on that a little.

Scoring.  The documents of a block are run side by side, window by window, with
the state carried to the end of each document.  Counts come from the whole
training corpus: each block's distinct words travel once, packed by ranges of
hash values, and their counts come back in the same order (``Counts``).  The
driver holds the head words, the class sums and the weights, all of fixed size.

Defined cases: a null or empty text is the end token alone.  Without training
documents every count is 0 and the network keeps its starting weights.  A null
doc_id counts as the empty text when the held-out part is chosen; rows with the
same doc_id are scored each.  An empty table gives an empty result.  Only doc_id
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stored
from .common import text_groups, to_long
from .words import word_hashes, word_suffixes

HEAD, CLASS_WORDS, TAIL = 1024, 32, 32
EMBED, HIDDEN = 16, 16
WINDOW, ROUNDS = 32, 2
LONG_WINDOW = 512
TRAIN_ROWS, SCORE_ROWS = 256, 1024
RATE = 0.02
BLOCK_BYTES = 2 << 20
TASK_TOKENS = 4_000_000
#: Tokens of the documents that a training task looks ahead over, and how many of them it starts early.
SORTED_TOKENS, EARLY = 4_000_000, 32
AVERAGED = 64
#: Tokens whose class probabilities are worked out at once.
PIECE = 1024
#: Words that a group of the count holds, about, and of how many blocks.
GROUP_WORDS, SHARE = 1 << 20, 1 << 16
#: Stands for the end of a document among the word hashes.
END_HASH = np.uint64(0x1D8AF066E0D5A1C3)
_HEAD_CLASSES = HEAD // CLASS_WORDS
_CLASSES = _HEAD_CLASSES + TAIL


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(group: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with the end tokens, tail classes, and first token of each text."""
    words, first = word_hashes(group)
    tails = word_suffixes(group, TAIL)
    at = first[1:]
    begin = first + np.arange(len(first))
    return np.insert(words, at, END_HASH), np.insert(tails, at, 0), begin


BLOCK_SCHEMA = "block long, ids array<string>, held array<boolean>, part array<int>, begins binary, words binary, tails binary, places binary"


def token_blocks(docs: DataFrame) -> DataFrame:
    """The blocks of ``docs`` (doc_id, text): of each document its id, whether it
    is held out, its training round and its first token; of the block its
    distinct words with their tail classes, and the place of each token among them."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for pdf in batches:
            for first, group in text_groups(list(pdf["text"]), BLOCK_BYTES):
                own = pdf.iloc[first : first + len(group)]
                words, tails, begins = tokens(group)
                distinct, where, places = np.unique(words, return_index=True, return_inverse=True)
                yield pd.DataFrame([{
                    "block": number, "ids": own["doc_id"].tolist(), "held": own["held"].tolist(), "part": own["part"].tolist(),
                    "begins": begins.astype(np.int64).tobytes(), "words": distinct.tobytes(), "tails": tails[where].astype(np.int8).tobytes(),
                    "places": _packed(places)}])
                number += 1

    round_of = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(ROUNDS)).cast("int")
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), round_of.alias("part"),
                       "text").mapInPandas(cut, BLOCK_SCHEMA)


def _packed(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers byte plane by byte plane, compressed: the high planes are nearly empty."""
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


class Block:
    """One block's arrays."""

    def __init__(self, row):
        self.begins, self.words = np.frombuffer(row["begins"], np.int64), np.frombuffer(row["words"], np.uint64)
        self.tails, self.places = np.frombuffer(row["tails"], np.int8), _unpacked(row["places"])
        self.held, self.part = np.asarray(row["held"], bool), np.asarray(row["part"], np.int64)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator:
    for pdf in batches:
        yield from (row for _, row in pdf.iterrows())


def _range_of(words: np.ndarray, ranges: int) -> np.ndarray:
    """In which of equal ranges of the hash values each word falls; sorted words stay sorted."""
    return ((words >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _slices(words: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The ranges that the sorted ``words`` fall into, with their places."""
    seen, first = np.unique(_range_of(words, ranges), return_index=True)
    yield from zip(seen.tolist(), map(slice, first.tolist(), [*first[1:].tolist(), len(words)]))


def _summed(words: list[np.ndarray], tails: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Distinct words, their tails and summed counts, and each word's place among them."""
    distinct, where, places = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    c = np.zeros(len(distinct), np.int64)
    np.add.at(c, places, np.concatenate(counts))
    return distinct, np.concatenate(tails)[where], c, places


class Counts:
    """How often each word occurs in the documents not held out (or in all).

    The words of a block are sorted, and go as one row for each of a number of
    ranges of hash values to the group of their range and of a share of the
    blocks (``SHARE`` at most).  A group adds up its blocks' counts, keeps the
    place of every block's words among its own, and sends its words on, in as
    many finer ranges as there are shares, to be added up over the shares.  So a
    group holds about ``GROUP_WORDS`` words in either step, however many blocks
    hold a word, and only the counts travel back.
    """

    def __init__(self, blocks: DataFrame, number: int, words: int, held: bool = False):
        self.shares = shares = max(1, -(-number // SHARE))
        ranges = max(1, -(-words // (shares * GROUP_WORDS)))

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for row in _rows(batches):
                b = Block(row)
                c = np.bincount(b.places[np.repeat(~b.held | held, np.diff(b.begins))], minlength=len(b.words))
                cut = list(_slices(b.words, ranges))
                yield pd.DataFrame({
                    "range": [k for k, _ in cut], "share": row["block"] % shares, "block": row["block"], "words": [b.words[at].tobytes() for _, at in cut],
                    "tails": [b.tails[at].tobytes() for _, at in cut], "c": [_packed(c[at]) for _, at in cut]})

        def add_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
            own = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
            words, tails, c, places = _summed(own, [np.frombuffer(t, np.int8) for t in pdf["tails"]], [_unpacked(c) for c in pdf["c"]])
            cut = list(_slices(words, ranges * shares))
            out = pd.DataFrame({
                "range": pdf["range"].iloc[0], "share": pdf["share"].iloc[0], "fine": [k for k, _ in cut], "words": [words[at].tobytes() for _, at in cut],
                "tails": [tails[at].tobytes() for _, at in cut], "c": [_packed(c[at], 8) for _, at in cut], "blocks": None, "sizes": None, "places": None})
            out.loc[0, ["blocks", "sizes", "places"]] = [pdf["block"].to_numpy(np.int64).tobytes(), np.array([len(w) for w in own], np.int64).tobytes(), _packed(places)]
            return out

        def add_shares(pdf: pd.DataFrame) -> pd.DataFrame:
            own = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
            words, tails, c, places = _summed(own, [np.frombuffer(t, np.int8) for t in pdf["tails"]], [_unpacked(c, 8).astype(np.int64) for c in pdf["c"]])
            out = pdf[["range", "share", "fine"]].reset_index(drop=True)
            out["totals"] = [_packed(c[at], 8) for at in np.split(places, np.cumsum([len(w) for w in own])[:-1])]
            out[["words", "tails", "c"]] = None
            out.loc[0, ["words", "tails", "c"]] = [words.tobytes(), tails.tobytes(), _packed(c, 8)]
            return out

        asked = (blocks.select("block", "held", "part", "begins", "words", "tails", "places")
                       .mapInPandas(ask, "range long, share long, block long, words binary, tails binary, c binary"))
        self.asked = stored(asked.groupBy("range", "share").applyInPandas(
            add_blocks, "range long, share long, fine long, words binary, tails binary, c binary, blocks binary, sizes binary, places binary"), "lm-asked")
        self.totals = stored(self.asked.select("range", "share", "fine", "words", "tails", "c").groupBy("fine").applyInPandas(
            add_shares, "range long, share long, fine long, totals binary, words binary, tails binary, c binary"), "lm-counts")

    def rows(self) -> DataFrame:
        """(word, tail, c) of the words that occur."""

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for row in _rows(batches):
                c = _unpacked(row["c"], 8).astype(np.int64)
                seen = np.flatnonzero(c)
                yield pd.DataFrame({"word": np.frombuffer(row["words"], np.int64)[seen], "tail": np.frombuffer(row["tails"], np.int8)[seen].astype(np.int32),
                                    "c": c[seen]})

        return self.totals.where("words IS NOT NULL").select("words", "tails", "c").mapInPandas(unpack, "word long, tail int, c long")

    def by_block(self) -> DataFrame:
        """(block, range, c): the counts of the block's words, range by range."""

        def give(asked: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
            row = asked.iloc[0]
            c = np.concatenate([_unpacked(t, 8) for t in totals.sort_values("fine")["totals"]])[_unpacked(row["places"])]
            ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
            return pd.DataFrame({"block": np.frombuffer(row["blocks"], np.int64), "range": row["range"], "c": [_packed(p, 8) for p in np.split(c, ends[:-1])]})

        keys = ["range", "share"]
        return (self.asked.where("places IS NOT NULL").select(*keys, "blocks", "sizes", "places").groupBy(*keys)
                    .cogroup(self.totals.select(*keys, "fine", "totals").groupBy(*keys)).applyInPandas(give, "block long, range long, c binary"))


def stored_blocks(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The blocks of ``docs``, their number and that of their distinct words."""
    seen = Observation("blocks")
    size = F.length("words") / F.lit(8)
    blocks = stored(token_blocks(docs).observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("words")), "lm-blocks")
    return blocks, seen.get["n"], seen.get["words"]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, tail, c) over all tokens of ``docs``."""
    return Counts(*stored_blocks(docs.select(F.lit(0).cast("long").alias("doc_id"), "text")), held=True).rows()


class Vocabulary:
    """Head words and class statistics, collected from the count table."""

    def __init__(self, counts: DataFrame):
        head = counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()
        self.total, self.distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        order = np.array([r["word"] for r in head], np.int64).view(np.uint64)
        self.head_counts = np.zeros(HEAD)
        self.head_counts[: len(head)] = [r["c"] for r in head]
        sort = np.argsort(order)
        self.head, self.head_id = order[sort], np.arange(len(order))[sort]
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.head >> np.uint64(48)).astype(np.int64)] = True
        self.tail_tokens, self.tail_words = np.zeros(TAIL), np.zeros(TAIL)
        for tail, n, v in counts.groupBy("tail").agg(F.sum("c"), F.count("*")).collect():
            self.tail_tokens[tail], self.tail_words[tail] = n, v
        for r in head:
            self.tail_tokens[r["tail"]] -= r["c"]
            self.tail_words[r["tail"]] -= 1

    def ids(self, words: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """Network inputs: head word number, or HEAD + tail class."""
        out = HEAD + tails.astype(np.int64)
        near = np.flatnonzero(self.bits[(words >> np.uint64(48)).astype(np.int64)])
        if len(self.head) and len(near):
            at = np.minimum(np.searchsorted(self.head, words[near]), len(self.head) - 1)
            same = self.head[at] == words[near]
            out[near[same]] = self.head_id[at[same]]
        return out

    @property
    def end(self) -> int:
        return int(self.ids(np.array([END_HASH]), np.array([0]))[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_softmax_at(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """One row of each column's log softmax (``x`` is overwritten)."""
    x -= x.max(axis=0)
    value = x[row, np.arange(x.shape[1])]
    np.exp(x, out=x)
    return value - np.log(x.sum(axis=0))


def _softmax(x: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each target, their order by class, and where each head class (and the rest) begins in it."""
    klass = np.where(target < HEAD, target // CLASS_WORDS, target - HEAD + _HEAD_CLASSES).astype(np.int16)
    order = np.argsort(klass, kind="stable")
    return klass, order, np.searchsorted(klass[order], np.arange(_HEAD_CLASSES + 1))


class Network:
    """The gated recurrent model; parameters live in one flat vector."""

    SHAPES = {"embed": (HEAD + TAIL, EMBED), "wx": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
              "wc": (HIDDEN, _CLASSES), "bc": (_CLASSES,), "wv": (_HEAD_CLASSES, HIDDEN, CLASS_WORDS), "bv": (_HEAD_CLASSES, CLASS_WORDS)}

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        at = 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> Network:
        """Small random weights; output biases at the corpus frequencies."""
        rng = np.random.default_rng(7)
        net = cls(rng.normal(0, 0.1, sum(int(np.prod(s)) for s in cls.SHAPES.values())))
        net.b[:] = 0
        net.b[:HIDDEN] = 1  # states start out lasting
        words = vocabulary.head_counts.reshape(_HEAD_CLASSES, CLASS_WORDS) + 0.01
        net.bv[:] = np.log(words / words.sum(axis=1, keepdims=True))
        mass = np.concatenate((words.sum(axis=1), vocabulary.tail_tokens + vocabulary.tail_words + 1))
        net.bc[:] = np.log(mass / mass.sum())
        net.wc[:] *= 0.1
        net.wv[:] *= 0.1
        return net

    def inputs(self) -> np.ndarray:
        """What each input adds to the gates."""
        return self.embed @ self.wx + self.b

    def run(self, x: np.ndarray, h: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """States after each of the inputs ``x`` (steps, rows), from ``h`` (rows, HIDDEN)."""
        return self._run(x, h, table)[0].transpose(1, 2, 0)

    def _run(self, x: np.ndarray, h: np.ndarray, table: np.ndarray | None = None, keep: bool = False) -> tuple[np.ndarray, ...]:
        """States (HIDDEN, steps, rows), and with ``keep`` the gates and the recurrent part of the candidate.

        A step's numbers lie feature by feature, so that its operations run
        over rows in one piece."""
        table = self.inputs() if table is None else table
        steps, rows = x.shape
        gates = np.ascontiguousarray(table.take(x, axis=0).transpose(0, 2, 1))  # of each step: (3 * HIDDEN, rows)
        states = np.empty((HIDDEN, steps, rows), np.float32)
        inner = np.empty((steps if keep else 1, HIDDEN, rows), np.float32)
        uzr, un = np.ascontiguousarray(self.u[:, : 2 * HIDDEN].T), np.ascontiguousarray(self.u[:, 2 * HIDDEN :].T)
        now, work = np.ascontiguousarray(h.T), np.empty((HIDDEN, rows), np.float32)
        recurrent = np.empty((2 * HIDDEN, rows), np.float32)
        for t in range(steps):
            zr, n, hn = gates[t, : 2 * HIDDEN], gates[t, 2 * HIDDEN :], inner[t if keep else 0]
            zr += np.matmul(uzr, now, out=recurrent)
            _sigmoid(zr)
            np.matmul(un, now, out=hn)
            n += np.multiply(zr[HIDDEN:], hn, out=work)
            np.tanh(n, out=n)
            now -= n
            now *= zr[:HIDDEN]
            now += n
            states[:, t] = now
        return states, gates, inner

    def log_probability(self, states: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log of the network's part for targets ``y``: the class, and
        the word inside a head class."""
        return self._log_probability(np.ascontiguousarray(states.T), y)

    def _log_probability(self, s: np.ndarray, y: np.ndarray) -> np.ndarray:
        klass, order, bounds = _by_class(y)
        out = np.empty(len(y))
        for i in range(0, len(y), PIECE):
            part = slice(i, i + PIECE)
            out[part] = _log_softmax_at(self.wc.T @ s[:, part] + self.bc[:, None], klass[part])
        order = order[: bounds[-1]]
        s, target = s[:, order], y[order] % CLASS_WORDS
        inside = np.empty(len(order), np.float32)
        for k in range(_HEAD_CLASSES):
            own = slice(bounds[k], bounds[k + 1])
            if own.start < own.stop:
                inside[own] = _log_softmax_at(self.wv[k].T @ s[:, own] + self.bv[k][:, None], target[own])
        out[order] += inside
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean loss over one window, and the last state."""
        steps, rows = x.shape
        grad = Network(np.zeros_like(self.flat))
        states, gates, inner = self._run(x, h, keep=True)
        s, target, valid = states.reshape(HIDDEN, -1), y.ravel(), mask.ravel()
        klass, order, bounds = _by_class(np.where(valid, target, HEAD + TAIL - 1))
        scale = np.float32(1 / max(1, int(valid.sum())))
        ds = np.empty_like(s)
        for i in range(0, len(target), PIECE):
            part = slice(i, i + PIECE)
            p = _softmax(self.wc.T @ s[:, part] + self.bc[:, None])
            p[klass[part], np.arange(p.shape[1])] -= 1
            p *= valid[part] * scale
            grad.wc += s[:, part] @ p.T
            grad.bc += p.sum(axis=1)
            np.matmul(self.wc, p, out=ds[:, part])
        order = order[: bounds[-1]]
        own_s, word = s[:, order], target[order] % CLASS_WORDS
        own_ds = np.empty_like(own_s)
        for k in range(_HEAD_CLASSES):
            own = slice(bounds[k], bounds[k + 1])
            if own.start < own.stop:
                q = _softmax(self.wv[k].T @ own_s[:, own] + self.bv[k][:, None])
                q[word[own], np.arange(q.shape[1])] -= 1
                q *= scale
                grad.wv[k], grad.bv[k] = own_s[:, own] @ q.T, q.sum(axis=1)
                np.matmul(self.wv[k], q, out=own_ds[:, own])
        ds[:, order] += own_ds
        ds = ds.reshape(HIDDEN, steps, rows)
        before = np.concatenate((np.ascontiguousarray(h.T)[:, None], states[:, :-1]), axis=1)
        # What the state's gradient is multiplied by, for all steps; only the recurrence is left to the loop.
        z, r, n = (gates[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        to_n, to_z, to_r = (1 - z) * (1 - n * n), (before.transpose(1, 0, 2) - n) * z * (1 - z), inner * r * (1 - r)
        dh, work = np.zeros((HIDDEN, rows), np.float32), np.empty((HIDDEN, rows), np.float32)
        # Of each step the gradients of its gates (z, r, n), then that of the candidate's recurrent part.
        into = np.empty((4 * HIDDEN, steps, rows), np.float32)
        uzr, un = np.ascontiguousarray(self.u[:, : 2 * HIDDEN]), np.ascontiguousarray(self.u[:, 2 * HIDDEN :])
        for t in range(steps - 1, -1, -1):
            dh += ds[:, t]
            own = into[:, t]
            dn, dhn = own[2 * HIDDEN : 3 * HIDDEN], own[3 * HIDDEN :]
            np.multiply(dh, to_n[t], out=dn)
            np.multiply(dh, to_z[t], out=own[:HIDDEN])
            np.multiply(dn, to_r[t], out=own[HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[t], out=dhn)
            dh *= z[t]
            dh += np.matmul(uzr, own[: 2 * HIDDEN], out=work)
            dh += np.matmul(un, dhn, out=work)
        into = into.reshape(4 * HIDDEN, -1)
        before = before.reshape(HIDDEN, -1)
        grad.u[:, : 2 * HIDDEN] = before @ into[: 2 * HIDDEN].T
        grad.u[:, 2 * HIDDEN :] = before @ into[3 * HIDDEN :].T
        dgates, inputs = into[: 3 * HIDDEN], x.ravel().astype(np.int16)
        grad.b[:] = dgates.sum(axis=1)
        grad.wx[:] = self.embed.take(inputs, axis=0).T @ dgates.T
        by_input = np.argsort(inputs, kind="stable")
        seen, first = np.unique(inputs[by_input], return_index=True)
        grad.embed[seen] = np.add.reduceat((dgates.T @ self.wx.T).take(by_input, axis=0), first, axis=0)
        return grad.flat, states[:, -1].T


def _long_ones_first(documents: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The documents as they come, but the ``EARLY`` longest of every
    ``SORTED_TOKENS`` first, so that long ones do not run alone in the end."""

    def ordered(held: list[np.ndarray]) -> Iterator[np.ndarray]:
        early = sorted(range(len(held)), key=lambda k: (-len(held[k]), k))[:EARLY]
        yield from (held[k] for k in early)
        rest = np.setdiff1d(np.arange(len(held)), early)
        yield from (held[k] for k in rest)

    held, size = [], 0
    for d in documents:
        held.append(d)
        size += len(d)
        if size >= SORTED_TOKENS:
            yield from ordered(held)
            held, size = [], 0
    yield from ordered(held)


def _train(net: Network, vocabulary: Vocabulary, batches: Iterator[pd.DataFrame]) -> tuple[np.ndarray, int]:
    """``_train_documents`` on the texts of ``batches``."""

    def documents() -> Iterator[np.ndarray]:
        for pdf in batches:
            for _, group in text_groups(list(pdf["text"])):
                words, tails, at = tokens(group)
                ids = vocabulary.ids(words, tails).astype(np.int16)
                yield from (ids[a:b] for a, b in zip(at[:-1], at[1:]))

    return _train_documents(net, vocabulary, documents())


def _train_documents(net: Network, vocabulary: Vocabulary, documents: Iterator[np.ndarray]) -> tuple[np.ndarray, int]:
    """Adam steps over the whole of one task's documents; weights and number of tokens.

    When few documents are left, windows hold few tokens; a step waits until
    its windows together hold half of a full one's, or the documents end.
    """
    m, v, step, learned = np.zeros_like(net.flat), np.zeros_like(net.flat), 0, 0
    end = vocabulary.end
    grad, held = np.zeros_like(net.flat), 0
    h = np.zeros((0, HIDDEN), np.float32)
    rows: list[np.ndarray] = []  # what is left of each running document, after the token read last
    waiting = (np.concatenate(([end], d)).astype(np.int16) for d in _long_ones_first(documents))
    while True:
        new = list(islice(waiting, TRAIN_ROWS - len(rows)))
        rows += new
        h = np.concatenate((h, np.zeros((len(new), HIDDEN), np.float32)))
        if rows:
            length = np.array([len(r) - 1 for r in rows])
            span = int(min(max(1, length.max()), max(WINDOW, min(LONG_WINDOW, WINDOW * TRAIN_ROWS // len(rows)))))
            table = np.full((len(rows), span + 1), end, np.int16)
            for j, row in enumerate(rows):
                part = row[: span + 1]
                table[j, : len(part)] = part
            table = np.ascontiguousarray(table.T)
            mask = np.arange(span)[:, None] < length[None, :]
            own, h = net.gradient(table[:-1], table[1:], mask, h)
            n = int(mask.sum())
            grad += own * n
            held += n
            learned += n
            live = np.flatnonzero(length > span)
            rows, h = [rows[j][span:] for j in live], h[live]
        if held >= TRAIN_ROWS * WINDOW // 2 or (held and not rows and not new):
            grad /= held
            step += 1
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            net.flat -= RATE / np.sqrt(1 + step / 50) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            grad[:], held = 0, 0
        if not rows and not new:
            return net.flat, learned


def _averaged(weights: DataFrame, count: int) -> np.ndarray | None:
    """The mean of the tasks' weights (columns task, sums, n), weighed by n."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(w, np.float64) for w in pdf["sums"])
        return pd.DataFrame([{"task": pdf["task"].iloc[0], "sums": total.tobytes(), "n": pdf["n"].sum()}])

    while count > AVERAGED:
        count = -(-count // AVERAGED)
        weights = stored(weights.withColumn("task", F.pmod("task", F.lit(count))).groupBy("task").applyInPandas(add, weights.schema), "lm-weights")
    rows = sorted(weights.collect(), key=lambda r: r["task"])
    if not rows:
        return None
    return (sum(np.frombuffer(r["sums"], np.float64) for r in rows) / sum(r["n"] for r in rows)).astype(np.float32)


def fit(blocks: DataFrame, vocabulary: Vocabulary) -> Network:
    """Train on the documents of ``blocks`` not held out by rounds of parallel descent."""
    net = Network.start(vocabulary)
    tasks = max(1, -(-int(vocabulary.total) // TASK_TOKENS))
    merged = blocks.select("held", "part", "begins", "words", "tails", "places").coalesce(tasks)
    for turn in range(ROUNDS):
        flat = net.flat

        def train(batches: Iterator[pd.DataFrame], flat: np.ndarray = flat, turn: int = turn) -> Iterator[pd.DataFrame]:
            def documents() -> Iterator[np.ndarray]:
                for row in _rows(batches):
                    b = Block(row)
                    ids = vocabulary.ids(b.words, b.tails).astype(np.int16)[b.places]
                    yield from (ids[b.begins[k] : b.begins[k + 1]].copy() for k in np.flatnonzero(~b.held & (b.part == turn)))

            weights, learned = _train_documents(Network(flat.copy()), vocabulary, documents())
            if learned:
                yield pd.DataFrame([{"task": TaskContext.get().partitionId(), "sums": (weights.astype(np.float64) * learned).tobytes(), "n": learned}])

        mean = _averaged(stored(merged.mapInPandas(train, "task long, sums binary, n long"), "lm-weights"), tasks)
        if mean is not None:
            net = Network(mean)
    return net


def _score_rows(net: Network, ids: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log of the network's part for whole documents, run side by side."""
    out = np.zeros(len(ids))
    order = np.argsort([-len(x) for x in ids], kind="stable")
    inputs = net.inputs()
    for i in range(0, len(order), SCORE_ROWS):
        rows = order[i : i + SCORE_ROWS]
        length = np.array([len(ids[r]) for r in rows])
        h = np.zeros((len(rows), HIDDEN), np.float32)
        last = np.full(len(rows), end, np.int64)
        w = 0
        while w < length[0]:
            live = int(np.searchsorted(-length, -w))  # documents longer than w
            span = int(min(length[0] - w, max(WINDOW, min(LONG_WINDOW, WINDOW * SCORE_ROWS // live))))
            y = np.full((span, live), end, np.int64)
            for j in range(live):
                part = ids[rows[j]][w : w + span]
                y[: len(part), j] = part
            x = np.concatenate((last[None, :live], y[:-1]))
            states = net._run(x, h[:live], inputs)[0]
            valid = np.arange(w, w + span)[:, None] < length[None, :live]
            value = np.zeros((span, live))
            value[valid] = net._log_probability(states[:, valid], y[valid])
            out[rows[:live]] += value.sum(axis=0)
            h, last = states[:, -1].T, y[-1]
            w += span
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks, number, words = stored_blocks(docs.select("doc_id", "text"))
    counts = Counts(blocks, number, words)
    vocabulary = Vocabulary(counts.rows())
    net = fit(blocks, vocabulary)
    total, distinct = int(vocabulary.total), int(vocabulary.distinct)

    def judge(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"doc_id": [], "held_out": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []})
        row = block.iloc[0]
        b = Block(row)
        c = np.concatenate([_unpacked(part, 8) for part in known.sort_values("range")["c"]]).astype(np.int64)
        # By distinct word first, then for each token.
        ids, tails = vocabulary.ids(b.words, b.tails), b.tails.astype(np.int64)
        log_c = np.log10(c + 1.0)
        rest = np.where(ids >= HEAD, log_c - np.log10(vocabulary.tail_tokens + vocabulary.tail_words + 1)[tails], 0.0)
        size, first = np.diff(b.begins), b.begins[:-1]
        base = np.add.reduceat(log_c[b.places], first) - size * np.log10(float(total + distinct + 1))
        network = _score_rows(net, np.split(ids.astype(np.int16)[b.places], first[1:]), vocabulary.end)
        return pd.DataFrame({
            "doc_id": row["ids"], "held_out": b.held, "n_tokens": size, "n_known": np.add.reduceat((c > 0)[b.places], first, dtype=np.int64),
            "base_score": base, "score": network / np.log(10) + np.add.reduceat(rest[b.places], first)})

    rows = (blocks.groupBy("block").cogroup(counts.by_block().groupBy("block"))
                  .applyInPandas(judge, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known",
                       F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
