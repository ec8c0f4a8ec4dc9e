from __future__ import annotations

import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from storelift.llm import queries, tokenfile
from storelift.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("<>abAB 12.,!?_-'\n\t éüß×÷ɏʰ日\x85\xa0\x1c|")), max_size=30), min_size=1, max_size=5))
def test_pieces_give_the_library_ids(whole, texts):
    got = tokenfile.encoder(PATH).encode(texts)
    assert [g.tolist() for g in got] == whole(texts)


def test_strings_of_added_tokens(whole):
    """They are the token's id, in plain texts and others."""
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "it's <|endoftext|>", "a<|endoftext|>b<|endoftext|>", "<|endoftext", "hello world"]
    got = [g.tolist() for g in tokenfile.Encoder(PATH).encode(texts)]
    assert got == whole(texts) and got[0] == [31373, 220, 50256, 995]


@pytest.mark.parametrize("bits", [3, 9])
def test_pieces_of_one_hash(whole, monkeypatch, bits):
    """Different pieces with one hash, in a batch and across batches, keep their ids."""
    real = tokenfile.span_hashes
    monkeypatch.setattr(tokenfile, "span_hashes", lambda *a: real(*a) >> np.uint64(64 - bits))
    enc = tokenfile.Encoder(PATH)
    texts = [f"w{i}" for i in range(60)] + ["a longer-than-sixteen incomprehensibilities incomprehensibilitiez", "incomprehensibilitiez"]
    for t in texts + texts:
        assert enc.encode([t])[0].tolist() == whole([t])[0]
    assert [g.tolist() for g in enc.encode(texts)] == whole(texts)


def test_cache_starts_afresh(whole, monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHE_PIECES", 50)
    enc = tokenfile.Encoder(PATH)
    texts = [" ".join(f"w{i * j}" for i in range(40)) for j in range(20)]
    for t in texts:
        assert enc.encode([t])[0].tolist() == whole([t])[0]


def test_digest_of_whole_table(spark, whole):
    rows = queries.op3_token_ids(spark, SF).toPandas().sort_values("doc_id", ignore_index=True)
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id", ignore_index=True)
    start = 0
    for i, ids in enumerate(whole(docs.text)):
        data = np.array([*ids, 0], "<u4").tobytes()
        assert (rows.doc_id[i], rows.start[i], rows.n_tokens[i], rows.ids_crc32[i]) == (docs.doc_id[i], start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1


def test_odd_rows_and_keyed_access(spark, odd_documents, no_documents, whole, monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfile, "ROWS_PER_SHARD", 5)
    path = f"{shared_dir(spark)}/tokens-test-{tmp_path.name}"
    tokenfile.write_ids(odd_documents, path, PATH)
    source = [(r.doc_id, r.text) for r in odd_documents.collect()]
    ids = {d: [*i, 0] for (d, _), i in zip(source, whole([t for _, t in source]))}
    rows = sorted(tokenfile.digest(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert [r.n_tokens for r in rows] == [len(ids[r.doc_id]) for r in rows]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    keys = spark.createDataFrame([(k,) for k in (2, 3, 8, 77, -1, None)], "doc_id long")
    got = sorted((r.doc_id, r.ids) for r in tokenfile.read_ids(spark, path, keys).collect())
    assert got == sorted([(2, ids[2]), (2, ids[2]), (3, ids[3]), (8, ids[8])])
    assert tokenfile.encode_digest(no_documents, PATH).count() == 0
