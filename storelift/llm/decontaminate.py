"""Benchmark decontamination: BM25 with block-max WAND, then verification.

Index: the benchmark items' words with item frequencies, lengths and BM25
impacts, built by Spark and split into blocks of ``ITEMS_PER_INDEX`` items; one
block's index is what a task holds, and the documents are searched against
each block in turn, so the index is bounded however many items there are.
Impacts are divided by the item's score against itself: a score is then the
share of an item that a passage covers, and one threshold fits short and long
items alike.

Queries: every document is cut into passages of twice the longest item,
starting every item length, so each possible copy lies whole in a passage.  A
passage's distinct words are the query.  Retrieval returns all items scoring
at least ``RETRIEVE_SHARE``:

* The frequent words are set aside as far as no item's score can come from
  them alone.  For many passages at once, the other words' impacts are added up
  item by item; passages in which no item can reach the threshold, even with
  all of its words set aside, are passed over.  This is the upper-bound test of WAND with bounds by item,
  and loses nothing.
* The other passages run document-at-a-time: cursors over the posting lists,
  a pivot from the lists' largest impacts, a second test with the impacts of
  the posting blocks around the pivot (block-max), full scores last.

Verification: the last sentence or line of an item is its answer, the text
before it the question (one sentence serves as both).  A word of the item is
covered if it lies in a five-word shingle of the item that the passage holds.
An item is leaked if at least ``OVERLAP`` of its words are covered, and at
least ``PART_OVERLAP`` of the question's and of the answer's.  Items under five
words are one shingle.

Defined cases: null or empty texts match nothing, and empty items are not
searched.  Equal items are reported each.  Rows with the same doc_id are
judged row by row.  Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_groups, to_long
from .words import shingle_hashes, word_hashes

K1, B = 1.2, 0.75
RETRIEVE_SHARE = 0.5
OVERLAP = 0.75
PART_OVERLAP = 0.5
SHINGLE = 5
ITEMS_PER_INDEX = 20_000
POSTINGS_PER_BLOCK = 64
#: Of the threshold, the most that words set aside may reach together.
ASIDE_SHARE = 0.6
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n")


def split_item(text: str) -> int:
    """Number of leading words that are the question (0: one part only)."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    cut = ends[-1] if ends else 0
    return len(re.findall(r"[^\x20\x09-\x0D]+", text[:cut]))


@dataclass
class Index:
    """Inverted index of one block of items."""

    item_ids: np.ndarray
    words: np.ndarray  # distinct word hashes, ascending
    first: np.ndarray  # posting range of each word, one entry more
    items: np.ndarray  # postings: item numbers, ascending within a word
    impact: np.ndarray  # postings: share of the item's own score
    item_words: list[np.ndarray]  # word hashes of each item in order
    questions: np.ndarray  # words of the question part
    longest: int
    top: np.ndarray = field(init=False)  # largest impact of each word
    blocks: list[tuple[np.ndarray, np.ndarray]] = field(init=False)  # last item and largest impact of each posting block
    aside: np.ndarray = field(init=False)  # words set aside
    need: np.ndarray = field(init=False)  # what the other words of each item must reach

    def __post_init__(self):
        n = len(self.words)
        self.top = np.maximum.reduceat(self.impact, self.first[:-1]) if n else np.empty(0)
        self.blocks = []
        for w in range(n):
            a, b = self.first[w], self.first[w + 1]
            at = np.arange(a, b, POSTINGS_PER_BLOCK)
            self.blocks.append((self.items[np.minimum(at + POSTINGS_PER_BLOCK, b) - 1], np.maximum.reduceat(self.impact, at)))
        # Frequent words first, while every item keeps below the share.
        sums = np.zeros(len(self.item_ids))
        self.aside = np.zeros(n, bool)
        for w in np.argsort(-np.diff(self.first), kind="stable"):
            a, b = self.first[w], self.first[w + 1]
            more = sums[self.items[a:b]] + self.impact[a:b]
            if more.max() >= ASIDE_SHARE * RETRIEVE_SHARE:
                break
            sums[self.items[a:b]] = more
            self.aside[w] = True
        self.need = RETRIEVE_SHARE - sums - 1e-9
        shingles = [shingle_hashes(w, np.array([0, len(w)]), SHINGLE)[0] for w in self.item_words]
        self.shingles = shingles
        rare = np.flatnonzero(~self.aside)
        self.rare, self.rare_words = rare, self.words[rare]
        self.rare_bits = np.zeros(1 << 16, bool)
        self.rare_bits[(self.rare_words >> np.uint64(48)).astype(np.int64)] = True

    def search(self, query: np.ndarray, threshold: float = RETRIEVE_SHARE) -> list[tuple[int, float]]:
        """(item number, score) of all items at or above ``threshold``, for
        the distinct word hashes ``query``: block-max WAND."""
        at = np.searchsorted(self.words, query)
        at = at[at < len(self.words)]
        at = at[np.isin(self.words[at], query)] if len(at) else at
        terms = [_Cursor(self, int(w)) for w in np.unique(at)]
        threshold -= 1e-9
        found = []
        while True:
            terms = [t for t in terms if t.item is not None]
            terms.sort(key=lambda t: t.item)
            bound, pivot = 0.0, None
            for i, t in enumerate(terms):
                bound += t.top
                if bound >= threshold:
                    pivot = i
                    break
            if pivot is None:
                return found
            item = terms[pivot].item
            while pivot + 1 < len(terms) and terms[pivot + 1].item == item:
                pivot += 1
            here = terms[: pivot + 1]
            if sum(t.block_top(item) for t in here) < threshold:
                # No item before the end of the nearest block can reach it.
                nearest = min(t.block_end(item) for t in here)
                beyond = terms[pivot + 1].item if pivot + 1 < len(terms) else nearest + 1
                target = max(item + 1, min(nearest + 1, beyond))
                for t in here:
                    t.seek(target)
            elif here[0].item == item:
                score = sum(t.value for t in here)
                if score >= threshold:
                    found.append((item, score))
                for t in here:
                    t.seek(item + 1)
            else:
                for t in here:
                    t.seek(item)


class _Cursor:
    """Position in one posting list."""

    def __init__(self, index: Index, word: int):
        a, b = index.first[word], index.first[word + 1]
        self.items, self.impact = index.items[a:b], index.impact[a:b]
        self.ends, self.tops = index.blocks[word]
        self.top, self.at = float(index.top[word]), 0
        self.item = int(self.items[0])

    @property
    def value(self) -> float:
        return float(self.impact[self.at])

    def seek(self, item: int) -> None:
        if self.item is not None and self.item < item:
            self.at += int(np.searchsorted(self.items[self.at :], item))
            self.item = int(self.items[self.at]) if self.at < len(self.items) else None

    def _block(self, item: int) -> int:
        return int(np.searchsorted(self.ends, item))

    def block_top(self, item: int) -> float:
        b = self._block(item)
        return float(self.tops[b]) if b < len(self.tops) else 0.0

    def block_end(self, item: int) -> int:
        b = self._block(item)
        return int(self.ends[b]) if b < len(self.ends) else int(self.ends[-1])


def item_words(items: DataFrame) -> DataFrame:
    """item_id, the item's word hashes in order, and its question length."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            rows = []
            for first, group in text_groups(texts):
                words, at = word_hashes(group)
                rows += [(pdf["item_id"].iloc[first + i], to_long(words[at[i] : at[i + 1]]), split_item(texts[first + i]))
                         for i in range(len(group)) if at[i + 1] > at[i]]
            if rows:
                yield pd.DataFrame(rows, columns=["item_id", "words", "question"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInPandas(
        hashed, "item_id string, words array<long>, question int")


def indexes(items: DataFrame) -> list[Index]:
    """One index for each block of items.

    Item frequencies, number and mean length are counted over all items; the
    driver builds one block's postings at a time.
    """
    hashed = item_words(items).cache()
    try:
        n, mean, longest = hashed.agg(F.count("*"), F.avg(F.size("words")), F.max(F.size("words"))).first()
        if not n:
            return []
        frequency = (hashed.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count())
        n_blocks = -(-n // ITEMS_PER_INDEX)
        blocked = hashed.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
        built = []
        for b in range(n_blocks):
            mine = blocked.where(F.col("block") == b)
            rows = sorted(mine.select("item_id", "words", "question").collect(), key=lambda r: (r[0] is None, r[0] and int(r[0])))
            words_here = mine.select(F.explode("words").alias("w")).distinct()
            df = dict(frequency.join(words_here, "w", "left_semi").collect())
            if rows:
                built.append(_index(rows, df, n, mean, longest))
        return built
    finally:
        hashed.unpersist()


def _index(rows: list, df: dict[int, int], n: int, mean: float, longest: int) -> Index:
    lists = [np.array(r[1], np.int64).view(np.uint64) for r in rows]
    words, items, impacts = [], [], []
    for i, own in enumerate(lists):
        w, tf = np.unique(own, return_counts=True)
        f = np.array([df[x] for x in to_long(w).tolist()])
        idf = np.log1p((n - f + 0.5) / (f + 0.5))
        score = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean))
        words.append(w)
        items.append(np.full(len(w), i))
        impacts.append(score / score.sum())
    words, items, impacts = map(np.concatenate, (words, items, impacts))
    order = np.lexsort((items, words))
    distinct, first = np.unique(words[order], return_index=True)
    return Index(np.array([None if r[0] is None else int(r[0]) for r in rows], object), distinct,
                 np.append(first, len(words)), items[order], impacts[order], lists,
                 np.array([r[2] for r in rows]), longest)


def overlaps(index: Index, item: int, passage: np.ndarray) -> tuple[float, float, float]:
    """Covered share of the item's words, of its question and of its answer.

    ``passage`` is a sorted array of shingle hashes (for an item under five
    words: of shingles of that item's length)."""
    words, q = index.item_words[item], int(index.questions[item])
    held = np.isin(index.shingles[item], passage)
    covered = np.zeros(len(words), bool)
    for i in np.flatnonzero(held):
        covered[i : i + SHINGLE] = True
    whole = float(covered.mean())
    if not 0 < q < len(words):
        return whole, whole, whole
    return whole, float(covered[:q].mean()), float(covered[q:].mean())


def _passage_shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Distinct shingles of a passage; for items under five words, its word
    sequences of that length hashed as such items are."""
    if length >= SHINGLE:
        return np.unique(shingle_hashes(words, np.array([0, len(words)]), SHINGLE)[0])
    n = max(0, len(words) - length + 1)
    return np.unique(np.concatenate([shingle_hashes(words[i : i + length], np.array([0, length]), SHINGLE)[0] for i in range(n)] or
                                    [np.empty(0, np.uint64)]))


def _possible(index: Index, words: np.ndarray, first: np.ndarray, cell: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Passages in which some item may reach the threshold.

    Texts are cut into cells of one item length; passage i of a text is its
    cells i and i + 1.  ``cell`` is the first cell of each text (one entry
    more), ``passages`` the number of its passages; returned are numbers
    cell + i."""
    near = np.flatnonzero(index.rare_bits[(words >> np.uint64(48)).astype(np.int64)])
    if not len(index.rare_words) or not len(near):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(index.rare_words, words[near]), len(index.rare_words) - 1)
    same = index.rare_words[at] == words[near]
    near, word = near[same], at[same]
    text = np.searchsorted(first, near, "right") - 1
    inside = (near - first[text]) // index.longest
    # Distinct (passage, word): a cell's words are in its own passage and the one before.
    m, n = len(index.rare_words), len(index.item_ids)
    pairs = []
    for shift in (0, 1):
        i = inside - shift
        ok = (i >= 0) & (i < passages[text])
        pairs.append((cell[text[ok]] + i[ok]) * m + word[ok])
    pair = np.unique(np.concatenate(pairs))
    if not len(pair):
        return pair
    passage, word = pair // m, index.rare[pair % m]
    # Every posting of every word, added up by passage and item.
    begin, count = index.first[word], index.first[word + 1] - index.first[word]
    upto = np.cumsum(count)
    posting = np.repeat(begin - (upto - count), count) + np.arange(upto[-1])
    key, inverse = np.unique(np.repeat(passage, count) * n + index.items[posting], return_inverse=True)
    total = np.bincount(inverse, index.impact[posting], len(key))
    return np.unique(key[total >= index.need[key % n] - 1e-6] // n)


def leaks(index: Index, texts: list[str | None]) -> Iterator[tuple[int, int, int, float, float, float, float]]:
    """(text, item, passage start, score, overlaps) of the leaked items in
    each text; of several passages with one item the best covered, then first."""
    step, span = index.longest, 2 * index.longest
    for begin, group in text_groups(texts):
        words, first = word_hashes(group)
        n = np.diff(first)
        # A passage starts at every cell but the last one (a single cell is one passage).
        cells = -(-n // step)
        passages = np.where(n > 0, np.maximum(1, cells - 1), 0)
        cell = np.concatenate(([0], np.cumsum(cells)))
        best: dict[tuple[int, int], tuple] = {}
        for p in _possible(index, words, first, cell, passages):
            t = int(np.searchsorted(cell, p, "right")) - 1
            start = int(first[t] + step * (p - cell[t]))
            passage = words[start : min(start + span, first[t + 1])]
            for item, score in index.search(np.unique(passage)):
                o = overlaps(index, item, _passage_shingles(passage, len(index.item_words[item])))
                if o[0] >= OVERLAP and min(o[1], o[2]) >= PART_OVERLAP:
                    key = (t, item)
                    if key not in best or o > best[key][2:]:
                        best[key] = (start - int(first[t]), score, *o)
        for (t, item), (start, score, *o) in sorted(best.items()):
            yield begin + t, item, start, score, *o


def leaked_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, passage_start (words), score, overlap,
    question_overlap, answer_overlap of every leaked item in every document."""
    schema = ("doc_id long, item_id long, passage_start long, score double, overlap double, "
              "question_overlap double, answer_overlap double")
    slim = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    parts = []
    for index in indexes(items):
        def search(batches: Iterator[pd.DataFrame], index: Index = index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = [(pdf["doc_id"].iloc[t], index.item_ids[i], *rest) for t, i, *rest in leaks(index, list(pdf["text"]))]
                if rows:
                    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
                    out["doc_id"] = out["doc_id"].map(lambda x: None if x is None else int(x)).astype("Int64")
                    yield out.astype({"item_id": "Int64"})
        parts.append(slim.mapInPandas(search, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _holds_none(index: Index):
    """A column function: whether a text holds none of the index's items."""

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        bad = {row[0] for row in leaks(index, list(text))}
        return pd.Series([i not in bad for i in range(len(text))], dtype=bool)

    return clean


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is leaked, with all columns."""
    for index in indexes(items):
        docs = docs.where(_holds_none(index)(F.col("text")))
    return docs
