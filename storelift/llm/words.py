"""Vectorised word hashing.

A word is a maximal run of bytes outside ASCII white space, A-Z lower-cased.
Words are hashed without a Python loop: with odd base B, the sum of
(byte + 1) * B^i over a word's positions comes from one cumulative sum modulo
2^64, and multiplying by B^-start makes it independent of the position.
"""

from __future__ import annotations

import numpy as np

from .common import ASCII_SPACE, mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACE)] = True
#: Longest stretch hashed with one cumulative sum; longer texts go piecewise.
PIECE = 1 << 20
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _BASE, np.uint64)
        up[0] = 1
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data``."""
    up, down = _power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``texts`` in order, and for each text the
    index of its first word (one more entry: the total).

    Empty texts have no words.  A text over ``PIECE`` bytes is cut at white
    space (a single longer word is kept whole).
    """
    if sum(map(len, texts)) > 2 * PIECE and len(texts) > 1:
        parts = [word_hashes([t]) for t in texts]
        counts = np.cumsum([0] + [len(h) for h, _ in parts])
        return np.concatenate([h for h, _ in parts]), counts
    joined = b"\n".join(texts).lower()
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_spans(data)
    if len(data) <= 2 * PIECE:
        hashes = span_hashes(data, starts, ends)
    else:
        hashes = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE)))
            a = starts[i]
            hashes[i:j] = span_hashes(data[a : ends[j - 1]], starts[i:j] - a, ends[i:j] - a)
            i = j
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, begins)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each text, and each text's
    first shingle index (one more entry: the total).

    A text with 1 to ``width`` - 1 words has one shingle, its whole word
    sequence; a text without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate(([0], np.cumsum(count)))
    out = np.empty(begin[-1], np.uint64)
    if not len(out):
        return out, begin
    # Positions of the first words of all full shingles, text by text.
    full = n >= width
    text = np.repeat(np.arange(len(n)), count)
    at = first[:-1][text] + np.arange(len(out)) - begin[:-1][text]
    factor = np.uint64(0x2545F4914F6CDD1D)
    whole = full[text]
    start = at[whole]
    h = np.zeros(len(start), np.uint64)
    for k in range(width):
        h = h * factor + words[start + k]
    out[whole] = mix64(h)
    for i in np.flatnonzero((n > 0) & ~full):
        h = np.uint64(n[i])
        with np.errstate(over="ignore"):
            for w in words[first[i] : first[i + 1]]:
                h = h * factor + w
        out[begin[i]] = mix64(np.array([h], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))[0]
    return out, begin


def word_suffixes(texts: list[bytes], buckets: int) -> np.ndarray:
    """A bucket from the last two bytes of each word of ``texts``, in the
    order of ``word_hashes``."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.int32)
    last, before = data[ends - 1].astype(np.uint32), data[np.maximum(ends - 2, starts)].astype(np.uint32)
    return ((mix64(((before << 8) | last).astype(np.uint64)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
