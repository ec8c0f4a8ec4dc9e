"""Minimal perfect hashing over distinct 64-bit keys.

Multi-level hashing with collision deferral (the BBHash construction): at each
level the remaining keys are hashed into a bit array of ``GAMMA`` slots a key;
keys alone in their slot are placed, the others go on to the next level.  The
index of a key is the number of set bits before its own over all levels, so n
keys map one to one onto 0 .. n-1 with about three bits a key.  Any other key
maps to some index or to -1; callers store a fingerprint to tell.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

GAMMA = 2.0
MAX_LEVELS = 64


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix64(keys + np.uint64(((level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    return (h % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> bytes:
    """The hash function over distinct uint64 ``keys`` as bytes."""
    keys = np.asarray(keys, np.uint64)
    sizes, bits = [], []
    left = keys
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
        slot = _slots(left, len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~alone[slot]]
    head = np.array([len(sizes), *sizes], np.uint64)
    return head.tobytes() + b"".join(b.tobytes() for b in bits)


class Lookup:
    """Constant-time evaluation of a built function, vectorised."""

    def __init__(self, blob: bytes):
        n = int(np.frombuffer(blob, np.uint64, 1)[0])
        self.sizes = [int(s) for s in np.frombuffer(blob, np.uint64, n, 8)]
        at, base = 8 * (n + 1), 0
        self.bits, self.ranks = [], []
        for size in self.sizes:
            raw = np.frombuffer(blob, np.uint8, size // 8, at)
            at += size // 8
            ones = np.unpackbits(raw).astype(bool)
            # Set bits before each byte; the rest of the rank is within one byte.
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(raw), dtype=np.int64)))
            self.bits.append((raw, ones))
            self.ranks.append(before[:-1] + base)
            base += int(before[-1])
        self.n = base

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            slot = _slots(keys[left], level, size)
            raw, ones = self.bits[level]
            hit = ones[slot]
            s = slot[hit]
            byte = raw[s >> 3] >> (8 - (s & 7)).astype(np.uint8)
            out[left[hit]] = self.ranks[level][s >> 3] + np.bitwise_count(byte)
            left = left[~hit]
        return out
