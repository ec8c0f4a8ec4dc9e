from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from storelift.llm import lm, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    tokens = [[*WORD.findall((t or "").translate(LOWER)), None] for _, t in rows]
    counts = Counter(w for h, own in zip(held, tokens) if not h for w in own)
    n, v = sum(counts.values()), len(counts)
    return [(d, h, len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
            for (d, _), h, own in zip(rows, held, tokens)]


def test_counts_base_and_gain(spark):
    rows = queries.op8_lm_score(spark, SF).toPandas().sort_values("doc_id", ignore_index=True)
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    for got, want in zip(rows.itertuples(index=False), plain([(r.doc_id, r.text) for r in docs])):
        assert (got.doc_id, got.held_out, got.n_tokens, got.n_known, got.train_tokens) == want[:5]
        assert abs(got.base_score - want[5]) < 1e-8 * got.n_tokens + 1e-9
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (held.score > held.base_score).mean() > 0.7


def test_probabilities_add_up(spark):
    """Over all known words and 'unknown', in any state."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    counts = lm.word_counts(docs)
    vocabulary = lm.Vocabulary(counts)
    net = lm.Network.start(vocabulary)
    rng = np.random.default_rng(0)
    net.flat[:] += rng.normal(0, 0.3, len(net.flat))
    states = np.repeat(rng.normal(0, 0.7, (1, lm.HIDDEN)).astype(np.float32), lm.HEAD + lm.TAIL, axis=0)
    p = np.exp(net.log_probability(states, np.arange(lm.HEAD + lm.TAIL)))
    # A tail class spreads its mass over its words and one unknown.
    words = counts.toPandas()
    tails = words[~words.word.isin(vocabulary.head.view(np.int64))]
    share = (tails["c"] + 1).groupby(tails["tail"]).sum().reindex(range(lm.TAIL), fill_value=0).to_numpy() + 1
    inside = share / (vocabulary.tail_tokens + vocabulary.tail_words + 1)
    assert abs((p[: lm.HEAD].sum() + (p[lm.HEAD :] * inside).sum()) - 1) < 1e-4


def test_gradient_by_differences(spark):
    counts = spark.createDataFrame([(int(i), int(i) % lm.TAIL, 100 + i) for i in range(1100)], "word long, tail int, c long")
    net = lm.Network.start(lm.Vocabulary(counts))
    rng = np.random.default_rng(4)
    net.flat[:] += rng.normal(0, 0.1, len(net.flat))
    x, y = rng.integers(0, lm.HEAD + lm.TAIL, (2, 6, 3))
    mask = rng.random((6, 3)) < 0.8
    h = rng.normal(0, 0.5, (3, lm.HIDDEN)).astype(np.float32)

    def loss(flat):
        n = lm.Network(flat.copy())
        return -n.log_probability(n.run(x, h)[mask], y[mask]).mean()

    grad, _ = net.gradient(x, y, mask, h)
    for _ in range(12):
        d = rng.normal(size=len(grad)).astype(np.float32)
        d /= np.linalg.norm(d)
        slope = (loss(net.flat + 0.05 * d) - loss(net.flat - 0.05 * d)) / 0.1
        assert abs(slope - grad @ d) < 0.02 * max(np.linalg.norm(grad) / 10, abs(slope)) + 2e-3


def test_state_is_carried_over_windows(spark, monkeypatch):
    """A document scores the same however the windows and batches fall."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    vocabulary = lm.Vocabulary(lm.word_counts(docs))
    net = lm.Network.start(vocabulary)
    net.flat[:] += np.random.default_rng(0).normal(0, 0.2, len(net.flat))
    ids = [np.random.default_rng(i).integers(0, lm.HEAD + lm.TAIL, n).astype(np.int16) for i, n in enumerate((1, 31, 32, 33, 70, 200))]
    whole = lm._score_rows(net, ids, vocabulary.end)
    monkeypatch.setattr(lm, "WINDOW", 7)
    monkeypatch.setattr(lm, "SCORE_ROWS", 2)
    assert np.allclose(lm._score_rows(net, ids, vocabulary.end), whole, rtol=1e-5)


def test_odd_rows(odd_documents, no_documents):
    rows = sorted(odd_documents.collect(), key=lambda r: repr(r.doc_id))
    got = sorted(lm.score(odd_documents).collect(), key=lambda r: repr(r.doc_id))
    for g, w in zip(got, plain([(r.doc_id, r.text) for r in rows])):
        assert tuple(g)[:5] == w[:5] and abs(g.base_score - w[5]) < 1e-6 * g.n_tokens and g.score < 0
    assert lm.score(no_documents).count() == 0
    alone = odd_documents.where("doc_id IN (1, 2)")
    assert all(g.score <= 0 for g in lm.score(alone).collect())


def test_training_learns_every_token_with_the_state_carried(spark, monkeypatch):
    """Each token of each document is a target once; windows of a document go on from its last state."""
    texts = [" ".join(f"w{(i * k) % 50}" for i in range(n)) for k, n in enumerate((700, 3, 64, 65, 31, 32, 500, 0), 1)]
    vocabulary = lm.Vocabulary(lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")))
    seen, carried = Counter(), []
    plain_gradient = lm.Network.gradient

    def gradient(self, x, y, mask, h):
        seen.update(y[mask].tolist())
        carried.append(h.copy())
        grad, last = plain_gradient(self, x, y, mask, h)
        states.append(last)
        return grad, last

    states = []
    monkeypatch.setattr(lm.Network, "gradient", gradient)
    monkeypatch.setattr(lm, "TRAIN_ROWS", 3)
    pdf = pd.DataFrame({"text": texts, "draw": np.arange(len(texts))})
    _, learned = lm._train(lm.Network.start(vocabulary), vocabulary, iter([pdf[:5], pdf[5:]]))
    words, tails, _ = lm.tokens([t.encode() for t in texts])
    assert seen == Counter(vocabulary.ids(words, tails).tolist()) and learned == len(words)
    for last, h in zip(states, carried[1:]):
        assert all(not row.any() or (row == last).all(axis=1).any() for row in h)
    assert any(h.any() for h in carried)


def test_counts_travel_packed(spark, monkeypatch):
    """A block's words go as a row a range, not a row a word; counts are whole for any number of ranges and shares."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(6)
    blocks, number, words = lm.stored_blocks(docs)
    assert number >= 6 and words == sum(len(r.words) // 8 for r in blocks.select("words").collect())
    whole = {(r.word, r.tail, r.c) for r in lm.Counts(blocks, number, words).rows().collect()}
    assert sum(c for *_, c in whole) == sum(n for _, held, n, *_ in plain([(r.doc_id, r.text) for r in docs.collect()]) if not held)
    monkeypatch.setattr(lm, "GROUP_WORDS", 5_000)
    monkeypatch.setattr(lm, "SHARE", 2)
    counts = lm.Counts(blocks, number, words)
    assert counts.shares == -(-number // 2) and {(r.word, r.tail, r.c) for r in counts.rows().collect()} == whole
    total, parts = {w: c for w, _, c in whole}, counts.by_block().orderBy("block", "range").collect()
    assert number < len(parts) <= number * -(-words // (5_000 * counts.shares))
    for row in blocks.collect():
        c = np.concatenate([lm._unpacked(p.c, 8) for p in parts if p.block == row.block])
        assert c.tolist() == [total.get(w, 0) for w in np.frombuffer(row.words, np.int64).tolist()]
