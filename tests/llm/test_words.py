"""Vectorised hashing against plain Python."""

from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from storelift.llm import mphf, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet=st.sampled_from("aAbB é\n\t\x0b日."), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_words_and_shingles(texts):
    raw = [t.encode() for t in texts]
    hashes, first = words.word_hashes(raw)
    plain = [WORD.findall(t.lower()) for t in raw]
    assert np.diff(first).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    shingles, at = words.shingle_hashes(hashes, first, 5)
    want = [[tuple(p[k : k + 5]) for k in range(len(p) - 4)] if len(p) >= 5 else ([tuple(p)] if p else []) for p in plain]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [s for w in want for s in w]
    assert len(set(zip(flat, shingles.tolist()))) == len(set(flat)) == len(set(shingles.tolist()))


def test_long_text_goes_piecewise(monkeypatch):
    text = (" ".join(f"w{i}" for i in range(5000))).encode()
    whole, _ = words.word_hashes([text, b"", b"tail"])
    monkeypatch.setattr(words, "PIECE", 64)
    pieces, first = words.word_hashes([text, b"", b"tail"])
    assert (whole == pieces).all() and first.tolist() == [0, 5000, 5000, 5001]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 50_000, dtype=np.uint64))
    blob = mphf.build(keys)
    assert sorted(mphf.Lookup(blob)(keys)) == list(range(len(keys)))
    assert len(blob) * 8 / len(keys) < 4
    assert (mphf.Lookup(mphf.build(keys[:0]))(keys[:3]) == -1).all()
