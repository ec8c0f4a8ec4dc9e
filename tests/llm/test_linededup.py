from __future__ import annotations

import hashlib
import re

from storelift.llm import linededup, queries
from storelift.llm.oracle import ORACLE_SQL
from tests.compare import compare, duck_connect

SF = "/root/testdata/sf0.01"


def brute(rows):
    """doc_id, lines, dropped, kept text, straight from the contract."""
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    at = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            at.setdefault(key(line), set()).add(-(2**63) if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        me = -(2**63) if d is None else d
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(at[key(x)]) > 1 and min(at[key(x)]) != me)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_against_oracle(spark):
    assert compare(queries.op7_line_dedup(spark, SF), duck_connect(SF), ORACLE_SQL["op7_line_dedup"], exact=True) == []


def test_odd_rows(odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(linededup, "BATCH_DOCS", 3)
    monkeypatch.setattr(linededup, "SHARD_KEYS", 1)
    want = brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(linededup.dedup_lines(odd_documents).collect()) == order(want)
    hashed = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in want]
    assert order(linededup.dedup_lines(odd_documents, digest=True).collect()) == order(hashed)
    assert linededup.dedup_lines(no_documents).count() == 0


def test_hot_line(spark):
    from pyspark.sql import functions as F

    line = F.when(F.col("id") % 3 == 0, F.lit("  A very common LINE ")).otherwise(F.concat(F.lit("own line number "), F.col("id").cast("string")))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(line, F.lit("\nshort\nshort")).alias("text"))
    rows = {r.doc_id: r for r in linededup.dedup_lines(docs).collect()}
    assert all(rows[i].n_dropped == (1 if i % 3 == 0 and i else 0) for i in range(900))
