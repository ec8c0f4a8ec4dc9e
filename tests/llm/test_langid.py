from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from storelift.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op5_language_id(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    rows = rows.merge(docs, on="doc_id")
    assert len(rows) == len(docs)
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(rows.doc_id, rows.held_out))
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.98
    assert rows.score.between(0, 1).all()


def test_prediction_uses_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    predict = langid.predictor(langid.fit(docs))
    a = docs.select("doc_id", predict("text").alias("p"))
    b = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}).select("doc_id", predict("text").alias("q"))
    assert a.join(b, "doc_id").where("NOT (p <=> q)").count() == 0


def test_families_and_pairs(spark):
    """Six languages in three families, of which one has a single member."""
    seeds = {"en": "the thing with wh", "de": "der sch ung ich", "nl": "het een ij van", "fr": "le eau qui ou", "es": "el cion que ll", "fi": "aa kk yy tta"}
    rows = [(i, " ".join((seeds[c].split() * 9)[i % 4 : i % 4 + 12 + i % 7]), c) for i, c in enumerate(sorted(seeds) * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.families == ["germanic", "romance", "uralic"] and len(model.pairs) == 4
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert sum(got[i] == c for i, _, c in rows) >= 0.97 * len(rows)


def test_odd_rows(odd_documents, no_documents):
    got = {r.doc_id: r for r in langid.identify(odd_documents).collect()}
    for d in (3, 4, 5, 10):
        assert (got[d].lang_pred, got[d].score) == ("und", 0.0)
    assert got[8].lang_pred in ("en", "fr", "de") and got[None].held_out is False
    assert langid.identify(no_documents).count() == 0
    alone = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(alone).collect()} == {"und"}
    kept = langid.accepted(odd_documents.withColumns({"lang_pred": F.lit(1), "score": F.lit(2)}), 0.0)
    assert kept.columns == [*odd_documents.columns, "lang_pred", "score"] and kept.where("doc_id in (3, 4, 5, 10)").count() == 0


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(0, "the one", "en"), (3, "\u00bd \u00b2", None), (4, "\u2460 \u2167 12", None), (5, "\u65e5", None), (6, "_", None)],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert [got[d] for d in (3, 4, 5, 6)] == ["und", "und", "en", "und"]


def test_more_languages_than_sample_rows(spark, monkeypatch):
    """Every language has one document but two, which are learned; nothing is ``und``."""
    monkeypatch.setattr(langid, "LANGUAGES", 8)
    rows = [(i, f"word{i} is here", f"x{i:05d}") for i in range(6000)]
    rows += [(6000 + i, "the thing with which they went there " * 3, "en") for i in range(60)]
    rows += [(7000 + i, "le eau qui ou que nous avons vu " * 3, "fr") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert len(model.langs) == 8 and {"en", "fr"} <= set(model.langs)
    got = langid.identify(docs).collect()
    assert "und" not in {r.lang_pred for r in got}
    own = {r.doc_id: r.lang_pred for r in got if r.doc_id >= 6000}
    assert sum(own[d] == ("en" if d < 7000 else "fr") for d in own) >= 110


def test_sample_is_bounded_in_rows(spark, monkeypatch):
    """One id repeated thousands of times, with one text and with many."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 40)
    docs = spark.range(6000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "IF(id % 2 = 0, 'the same', concat('le mot ', id)) AS text",
                                        "IF(id % 2 = 0, 'en', 'fr') AS lang")
    seen = []
    real = langid.Model
    monkeypatch.setattr(langid, "Model", lambda x, langs: seen.append(langs.tolist()) or real(x, langs))
    langid.fit(docs)
    assert seen[0].count("en") == 1 and seen[0].count("fr") == 20
