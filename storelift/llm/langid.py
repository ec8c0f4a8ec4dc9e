"""Language identification by hierarchical discrimination.

A text's features are hashed counts of its byte trigrams (A-Z lower-cased),
square-rooted and scaled to unit length.  A linear model predicts the language
family first; inside a family, one linear support vector machine for each pair
of languages votes.  All machines minimise the squared hinge loss with L2
regularisation by accelerated gradient descent, on labelled documents only.

The classifier is fitted on a bounded sample: at most ``SAMPLE_ROWS`` labelled
documents in all, the same number for each language, chosen by a hash of id and
text (repeated rows count once).  At most ``LANGUAGES`` languages are learned,
those with the most documents.  Before the choice, each language's rows are cut by
a hash threshold to little more than are wanted, so no task gets all rows of
one.  Features are computed from whole texts, for the sample and for prediction.
The fitted weights (``FEATURES`` floats for each family and pair) go to the
tasks with the prediction function.

Language, source and id are never inputs of a prediction.  The score is the
family's probability times the mean pairwise probability, from 0 to 1.

Defined cases: null texts and texts without letters (Unicode category L) are
``und`` with score 0.
Without any labelled training document every text is ``und`` with score 0; with
one language that language is predicted with score 1.  Ties go to the
language that sorts first.  A null doc_id counts as the empty text when the
held-out third is chosen.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_groups

FEATURES = 2048
SAMPLE_ROWS = 4_000
LANGUAGES = 256
STEPS = 150
L2 = 1e-4
PREDICT_ROWS = 1_000
#: Documents scored below this by the pipeline stage are rejected, as are ``und`` ones.
REJECT_BELOW = 0.35

# Families of common language codes.  A language outside the
# table is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "ast"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne", "si"),
    "semitic": ("ar", "he", "mt", "am"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], f"lang:{lang}")


def held_out(doc_id: Column) -> Column:
    """The third of documents never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def features(texts: list[str | None]) -> np.ndarray:
    """Unit-length feature rows; zero for texts under three bytes."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for begin, group in text_groups(texts):
        # Two separators keep the trigrams of one text off the next one.
        data = np.frombuffer(b"\n\n".join(group).lower() + b"\n\n", np.uint8).astype(np.uint32)
        code = data[:-2] * np.uint32(0x01000193) ^ data[1:-1] * np.uint32(0x9E3779B1) ^ data[2:] * np.uint32(0x85EBCA6B)
        code = ((code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int64)
        sizes = np.array([len(t) for t in group])
        begins = np.cumsum(sizes + 2) - (sizes + 2)
        for i in range(len(group)):
            if sizes[i]:
                out[begin + i] = np.bincount(code[begins[i] : begins[i] + sizes[i]], minlength=FEATURES)
    np.sqrt(out, out=out)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0)


def fit_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a two-class linear SVM (``y`` is +1 or -1).

    Classes weigh the same however many rows they have.
    """
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, np.float32)
    # Rows have length at most sqrt(2) with the bias, which bounds the curvature.
    step = 1.0 / (4.0 * float(cost.sum()) + L2)
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1])) * cost
        g = -2 * y * slack
        grad = np.append(g @ x, g.sum()).astype(np.float32)
        grad[:-1] += L2 * ahead[:-1]
        new = ahead - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + ((t - 1) / t_new) * (new - w)
        w, t = new, t_new
    return w


class Model:
    """Family machines, and pairwise machines inside each family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        self.families = sorted({family_of(c) for c in self.langs})
        own = np.array([family_of(c) for c in langs])
        if len(self.families) == 2:
            w = fit_svm(x, np.where(own == self.families[0], 1, -1).astype(np.float32))
            self.family_weights = np.stack((w, -w))
        elif len(self.families) > 2:
            self.family_weights = np.stack([fit_svm(x, np.where(own == f, 1, -1).astype(np.float32)) for f in self.families])
        else:
            self.family_weights = np.zeros((len(self.families), FEATURES + 1), np.float32)
        self.members = {f: [c for c in self.langs if family_of(c) == f] for f in self.families}
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                rows = (langs == a) | (langs == b)
                self.pairs[a, b] = fit_svm(x[rows], np.where(langs[rows] == a, 1, -1).astype(np.float32))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each feature row."""
        squash = lambda m: 1 / (1 + np.exp(-4 * m))
        lang, score = np.empty(len(x), object), np.zeros(len(x))
        if not self.langs:
            lang[:] = "und"
            return lang, score
        f = x @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        p = squash(f)
        p = p / p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        for k, family in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            members = self.members[family]
            if len(members) == 1:
                lang[rows], score[rows] = members[0], p[rows, k]
                continue
            votes, mass = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                w = self.pairs[members[a], members[b]]
                q = squash(x[rows] @ w[:-1] + w[-1])
                votes[:, a] += q >= 0.5
                votes[:, b] += q < 0.5
                mass[:, a] += q
                mass[:, b] += 1 - q
            mass /= len(members) - 1
            win = np.lexsort((-mass, -votes), axis=1)[:, 0] if len(rows) else np.empty(0, int)
            lang[rows] = np.array(members, object)[win]
            score[rows] = p[rows, k] * mass[np.arange(len(rows)), win]
        return lang, score


def fit(docs: DataFrame) -> Model:
    """Fit on a sample of the labelled documents that are not held out."""
    labelled = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
                    .select("lang", "text", F.xxhash64("doc_id", "text").alias("_k")))
    counts = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_k").alias("distinct"))
                      .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())
    per_lang = SAMPLE_ROWS // max(1, len(counts))
    # Of a language's distinct rows, about those wanted and a margin pass its threshold.
    wanted = 1.3 * per_lang + 8 * per_lang**0.5 + 40
    spark = docs.sparkSession
    shares = spark.createDataFrame([(r["lang"], min(1.0, wanted / max(1, r["distinct"]))) for r in counts], "lang string, _share double")
    order = Window.partitionBy("lang").orderBy("_k")
    chosen = (labelled.select("lang", "_k").join(F.broadcast(shares), "lang")
                      .where(F.pmod("_k", F.lit(1 << 31)) < F.col("_share") * (1 << 31)).select("lang", "_k").distinct()
                      .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_lang).select("lang", "_k"))
    # Chosen by key first, so that only the sample's texts are shuffled, each once.
    sample = (labelled.join(F.broadcast(chosen), ["lang", "_k"], "left_semi")
                      .groupBy("lang", "_k").agg(F.min("text").alias("text")).select("text", "lang"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"x": [r.tobytes() for r in features(list(pdf["text"])).astype(np.float16)], "lang": pdf["lang"].to_numpy()})

    got = sample.mapInPandas(rows, "x binary, lang string").collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32) if got else np.zeros((0, FEATURES), np.float32)
    return Model(x, np.array([r["lang"] for r in got], object))


def predictor(model: Model):
    """A column function from text to (lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        texts = list(text)
        # A batch's feature rows would be far larger than its texts: some at a time.
        parts = [model.predict(features(texts[i : i + PREDICT_ROWS])) for i in range(0, len(texts), PREDICT_ROWS)]
        lang = np.concatenate([p[0] for p in parts] or [np.empty(0, object)])
        score = np.concatenate([p[1] for p in parts] or [np.empty(0)])
        none = np.array([t is None or not _LETTER.search(t) for t in texts], bool)
        lang[none], score[none] = "und", 0.0
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    predict = predictor(fit(docs))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p"))
                .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def accepted(docs: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all columns."""
    predict = predictor(fit(docs))
    p = predict(F.col("text"))
    return docs.where((p["lang_pred"] != "und") & (p["score"] >= reject_below))
