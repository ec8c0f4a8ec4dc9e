"""Main-text extraction with gradient-boosted trees over DOM nodes.

Every block-level element of a page is a row of features: text and link
density of its subtree, attribute tokens, tag, depth, and how it compares with
its siblings and the page.  Boosted trees give each node's probability of
belonging to the main text.  Decoding is hierarchical: dropping a node drops its
whole subtree, so no kept node has a dropped ancestor; among all such choices
the most probable one is found by one pass from the leaves and one from the
root.  The text is the kept nodes' blocks in page order.

Training needs no hand labels.  Pages that mark their parts supervise: elements
of the content kind (article, main) and what they hold are positive, elements of
the boilerplate kinds and everything outside the content are negative.  Each
sampled page is seen as it is, with its marks hidden (attributes removed;
section tags renamed as well), so that text and structure carry the decision
where a page marks nothing, and recast: its own blocks set into other elements
(lists, quotes, tables; asides, comments, notices, forms), so that the marks of
all kinds are learned, also inside the content.  The model is fitted on at most
``SAMPLE_PAGES`` pages, chosen by a hash of their id; if they mark no content,
long blocks with few links stand in for the marks.  Every page is extracted,
from its whole html.

Defined cases: null and empty html give an empty text, as do pages without any
kept block.  Without a page to learn from nothing is kept.  Equal page ids are
extracted each.  Further columns are not read.
"""

from __future__ import annotations

import html
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .htmltree import Page, read_page

SAMPLE_PAGES = 400
ROUNDS, DEPTH, RATE, BINS = 60, 4, 0.2, 32
#: Pages whose nodes go through the trees together.
PAGES_AT_ONCE = 200
_ASCII_UPPER = bytes(range(65, 91))

# Words that name the parts of a page in tags, classes and roles.
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav aside footer header form menu dialog search fieldset dir".split())
CONTENT_WORDS = frozenset("article main content post entry story".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert advertisement alert aside author banner bar bio blogroll bottom breadcrumb breadcrumbs byline button buttons "
    "caption categories complementary comment comments consent contentinfo cookie cookies copyright credits dialog disclaimer discussion "
    "disqus dropdown feedback foot footer form gdpr head header login legal links masthead menu message meta modal nav navbar navigation "
    "newsletter notice notification outbrain overlay pager pagination popup privacy promo promoted promotion recommended related replies "
    "reply respond rss search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe subscription tabs taboola tags "
    "teaser toc toolbar top topbar trending warning widget widgets".split())
#: Section tags that are renamed when a page's marks are hidden.
SECTION_TAGS = CONTENT_TAGS | BOILERPLATE_TAGS | {"section"}

FEATURES = ("chars", "words", "blocks", "link_share", "mean_block", "longest_block", "nodes", "depth", "page_share", "parent_share",
            "siblings", "place", "sentence_rate", "comma_rate", "upper_share", "content_tag", "boilerplate_tag", "content_word",
            "boilerplate_word", "above_content", "above_boilerplate", "paragraph", "heading", "list", "fields", "paragraph_share",
            "before_share", "next_chars", "previous_chars")


def _marks(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes their tag or attributes call content, and boilerplate."""
    boiler = np.array([t in BOILERPLATE_TAGS or bool(w & BOILERPLATE_WORDS) for t, w in zip(page.tag, page.tokens)])
    content = np.array([t in CONTENT_TAGS or bool(w & CONTENT_WORDS) for t, w in zip(page.tag, page.tokens)]) & ~boiler
    return content, boiler


def _down(page: Page, own: np.ndarray) -> np.ndarray:
    """Whether a node or an ancestor of it has the property."""
    out = own.copy()
    for i, p in enumerate(page.parent):
        if p >= 0 and out[p]:
            out[i] = True
    return out


def _up(page: Page, own: np.ndarray) -> np.ndarray:
    """Sums of ``own`` over subtrees (rows by node)."""
    out = own.astype(np.float64).copy()
    for i in range(len(page.parent) - 1, 0, -1):
        out[page.parent[i]] += out[i]
    return out


def _hidden(page: Page, tags: bool) -> Page:
    """The page without attribute tokens, and with section tags as ``div``."""
    tag = ["div" if tags and t in SECTION_TAGS else t for t in page.tag]
    return Page(tag, page.parent, page.depth, [frozenset()] * len(tag), page.fields, page.block_node, page.block_text, page.block_link)


def recast(page: Page, draw: int) -> Page:
    """The page's own blocks set into other elements, by the number ``draw``.

    Content blocks stay in a marked content element, as paragraphs, headings,
    list items, quotes or cells.  Boilerplate blocks, and now and then a content
    block in the part of a comment or notice, go into boilerplate elements before,
    inside and after it.
    """
    rng = np.random.default_rng(zlib.crc32(("\n".join(page.block_text)).encode("utf-8", "surrogatepass")) + draw)
    label = weak_labels(page)
    content = [html.escape(t) for i, t in zip(page.block_node, page.block_text) if label[i] == 1]
    other = [html.escape(t) for i, t in zip(page.block_node, page.block_text) if label[i] == 0]
    words, tags = sorted(BOILERPLATE_WORDS), ["nav", "aside", "footer", "header", "form", "menu"]
    pick = lambda options: options[int(rng.integers(len(options)))]

    def boiler() -> str:
        texts = [pick(other) for _ in range(int(rng.integers(1, 5)))] if other else []
        if content and (not texts or rng.random() < 0.5):
            texts = [pick(content) for _ in range(int(rng.integers(1, 4)))]
        link = rng.random() < 0.4
        body = "".join(f"<{e}>{f'<a href=x>{t}</a>' if link else t}</{e}>" for t in texts for e in [pick(["p", "li", "div", "h3"])])
        if rng.random() < 0.5:
            tag = pick(tags)
            return f"<{tag}>{body}</{tag}>"
        return f'<div class="{pick(words)}{pick(["", "-box", "_area", " wide"])}">{body}</div>'

    def shown(text: str) -> str:
        form = rng.random()
        if form < 0.6:
            return f"<p>{text}</p>"
        if form < 0.7:
            return f"<ul><li>{text}</li></ul>"
        if form < 0.8:
            return f"<blockquote>{text}</blockquote>"
        if form < 0.9:
            return f"<table><tr><td>{text}</td></tr></table>"
        return f"<div><h2>{text[:40]}</h2><p>{text}</p></div>"

    parts = [shown(t) + (boiler() if rng.random() < 0.15 else "") for t in content]
    start, end = pick([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
                       ('<div id="post">', "</div>"), ('<main><div class="entry">', "</div></main>")])
    around = [boiler() for _ in range(int(rng.integers(1, 5)))]
    cut = int(rng.integers(len(around) + 1))
    return read_page("<body>" + "".join(around[:cut]) + start + "".join(parts) + end + "".join(around[cut:]) + "</body>")


def _upper(text: str) -> int:
    """Number of upper-case characters."""
    if text.isascii():
        return len(text) - len(text.encode().translate(None, _ASCII_UPPER))
    return sum(map(str.isupper, text))


def node_features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` for each node."""
    n = len(page.tag)
    node = np.array(page.block_node, np.int64)
    own = np.zeros((n, 8))
    if len(node):
        text = page.block_text
        chars = np.array([len(t) for t in text])
        per_block = np.stack((
            chars, [t.count(" ") + 1 for t in text], np.ones(len(text)), np.minimum(page.block_link, chars),
            [t.count(".") + t.count("!") + t.count("?") for t in text], [t.count(",") for t in text],
            [_upper(t) for t in text],
            np.where([page.tag[i] == "p" for i in node], chars, 0)), axis=1)
        np.add.at(own, node, per_block)
    total = _up(page, own)
    longest = np.zeros(n)
    if len(node):
        np.maximum.at(longest, node, chars)
    parent = np.array(page.parent)
    nodes = _up(page, np.ones(n))
    fields = _up(page, np.array(page.fields, float))
    for i in range(n - 1, 0, -1):
        longest[parent[i]] = max(longest[parent[i]], longest[i])
    chars = total[:, 0]
    content, boiler = _marks(page)
    above = np.maximum(parent, 0)
    content_word = np.array([bool(w & CONTENT_WORDS) for w in page.tokens])
    boiler_word = np.array([bool(w & BOILERPLATE_WORDS) for w in page.tokens])
    boiler_tag = np.array([t in BOILERPLATE_TAGS for t in page.tag])
    siblings, place = np.zeros(n), np.zeros(n)
    before, previous, following = np.zeros(n), np.zeros(n), np.zeros(n)
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        children.setdefault(page.parent[i], []).append(i)
    for kids in children.values():
        k = np.array(kids)
        siblings[k], place[k] = len(k), np.arange(len(k)) / len(k)
        c = chars[k]
        before[k] = np.cumsum(c) - c
        previous[k[1:]], following[k[:-1]] = c[:-1], c[1:]
    safe = np.maximum(chars, 1)
    tag = page.tag
    return np.stack((
        np.log1p(chars), np.log1p(total[:, 1]), np.log1p(total[:, 2]), total[:, 3] / safe, np.log1p(chars / np.maximum(total[:, 2], 1)),
        np.log1p(longest), np.log1p(nodes), np.minimum(page.depth, 8).astype(float), chars / max(1.0, chars[0]), chars / safe[above],
        np.log1p(siblings), place, 100 * total[:, 4] / safe, 100 * total[:, 5] / safe, total[:, 6] / safe,
        np.array([t in CONTENT_TAGS for t in tag], float), boiler_tag.astype(float), content_word.astype(float), boiler_word.astype(float),
        _down(page, content)[above] * (parent >= 0), _down(page, boiler)[above] * (parent >= 0),
        np.array([t == "p" for t in tag], float), np.array([len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in tag], float),
        np.array([t in ("li", "ul", "ol") for t in tag], float), np.log1p(fields), total[:, 7] / safe,
        before / safe[above], np.log1p(following), np.log1p(previous)), axis=1).astype(np.float32)


def weak_labels(page: Page) -> np.ndarray:
    """1 main text or around it, 0 boilerplate, -1 unknown."""
    content, boiler = _marks(page)
    out = np.full(len(page.tag), -1)
    bad = _down(page, boiler)
    if content.any():
        inside = _down(page, content) & ~bad
        around = _up(page, content & ~bad) > 0
        out[:] = 0
        out[inside | (around & ~bad)] = 1
    else:
        out[bad] = 0
    out[0] = -1
    return out


def views_rows(views: list[tuple[Page, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled nodes."""
    return (np.concatenate([node_features(p)[label >= 0] for p, label in views]),
            np.concatenate([label[label >= 0] for _, label in views]))


def text_labels(page: Page) -> np.ndarray:
    """Stand-in labels of pages without marks: long blocks with few links."""
    good = np.zeros(len(page.tag))
    for node, text, link in zip(page.block_node, page.block_text, page.block_link):
        good[node] += len(text) >= 80 and link < len(text) / 4
    out = (_up(page, good) > 0).astype(int)
    out[0] = -1
    return out


class Trees:
    """Gradient-boosted regression trees for a logistic loss, on histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base, self.trees = 0.0, []
        if not len(y) or y.min() == y.max():
            self.base = 4.0 if len(y) and y[0] else -4.0
            return
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        margin = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            tree, leaf = self._grow(binned, cuts, p - y, p * (1 - p))
            margin += tree[2][leaf]
            self.trees.append(tree)

    @staticmethod
    def _grow(binned: np.ndarray, cuts: list, g: np.ndarray, h: np.ndarray) -> tuple:
        """A complete binary tree: feature, cut and value by heap position; the rows' leaves."""
        size = 2 ** (DEPTH + 1) - 1
        feature, cut = np.zeros(size, np.int64), np.full(size, np.inf)
        at = np.zeros(len(g), np.int64)
        lam = 1.0
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = at - first
            gain = np.zeros(width)
            split = np.zeros((width, 2), np.int64)
            gs, hs = np.bincount(local, g, width), np.bincount(local, h, width)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                k = len(c) + 1
                key = local * k + binned[:, f]
                gl = np.bincount(key, g, width * k).reshape(width, k).cumsum(axis=1)[:, :-1]
                hl = np.bincount(key, h, width * k).reshape(width, k).cumsum(axis=1)[:, :-1]
                gr, hr = gs[:, None] - gl, hs[:, None] - hl
                score = gl**2 / (hl + lam) + gr**2 / (hr + lam) - (gs**2 / (hs + lam))[:, None]
                score[(hl < 1) | (hr < 1)] = 0
                best = score.argmax(axis=1)
                value_at = score[np.arange(width), best]
                better = value_at > gain + 1e-9
                gain[better], split[better, 0], split[better, 1] = value_at[better], f, best[better]
            for j in np.flatnonzero(gain > 1e-6):
                feature[first + j], cut[first + j] = split[j, 0], cuts[split[j, 0]][split[j, 1]]
            bin_cut = np.where(gain > 1e-6, split[:, 1], 1 << 30)
            at = 2 * at + 1 + (binned[np.arange(len(g)), split[local, 0]] > bin_cut[local])
        leaf_g, leaf_h = np.bincount(at, g, size), np.bincount(at, h, size)
        value = -RATE * leaf_g / (leaf_h + lam)
        return (feature, cut, value), at

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at]
        return out


def decode(page: Page, margin: np.ndarray) -> np.ndarray:
    """The most probable keep or drop of every node in which a dropped node
    has no kept descendant.  ``margin`` is the log odds of keeping."""
    n = len(page.tag)
    keep = margin.clip(-20.0, 20.0).astype(float)
    keep[0] = 0.0
    # Gain of keeping a subtree in its best way over dropping all of it.
    for i in range(n - 1, 0, -1):
        if keep[i] > 0:
            keep[page.parent[i]] += keep[i]
    out = keep > 0
    out[0] = True
    for i in range(1, n):
        out[i] &= out[page.parent[i]]
    return out


def main_texts(pages: list[Page], model: Trees) -> list[str]:
    """The main text of each page; the trees run over all their nodes at once."""
    if not pages:
        return []
    margin = model.margin(np.concatenate([node_features(p) for p in pages]))
    out = []
    for page, own in zip(pages, np.split(margin, np.cumsum([len(p.tag) for p in pages])[:-1])):
        kept = decode(page, own)
        out.append("\n".join(t for i, t in zip(page.block_node, page.block_text) if kept[i]))
    return out


def main_text(page: Page, model: Trees) -> str:
    return main_texts([page], model)[0]


def fit(pages: DataFrame) -> Trees:
    """Fit on the sampled pages; the driver holds their nodes' features."""
    chosen = pages.select("page_id", F.xxhash64("page_id").alias("h")).distinct().orderBy("h", "page_id").limit(SAMPLE_PAGES).select("page_id")
    sample = pages.where("html IS NOT NULL").join(F.broadcast(chosen), "page_id", "left_semi")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for source in pdf["html"]:
                page = read_page(source)
                for kind, label in ((0, weak_labels(page)), (1, text_labels(page))):
                    views = [(page, label)]
                    if kind == 0:
                        views += [(_hidden(page, False), label), (_hidden(page, True), label)]
                        views += [(again, weak_labels(again)) for again in (recast(page, d) for d in range(3)) if (label == 1).any()]
                    x, y = views_rows(views)
                    if len(y):
                        yield pd.DataFrame({"kind": [kind], "x": [x.astype("<f4").tobytes()], "y": [y.astype(np.int8).tobytes()]})

    got = sorted(sample.select("html").mapInPandas(rows, "kind int, x binary, y binary").collect(), key=lambda r: bytes(r["x"]))

    def stack(kind: int) -> tuple[np.ndarray, np.ndarray]:
        own = [r for r in got if r["kind"] == kind]
        if not own:
            return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0)
        return (np.concatenate([np.frombuffer(r["x"], "<f4").reshape(-1, len(FEATURES)) for r in own]),
                np.concatenate([np.frombuffer(r["y"], np.int8) for r in own]).astype(float))

    x, y = stack(0)
    if not len(y) or y.min() == y.max():
        x, y = stack(1)
    return Trees(x, y)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = fit(pages.select("page_id", "html"))

    @F.pandas_udf("string")
    def text(source: pd.Series) -> pd.Series:
        out: list[str] = []
        for i in range(0, len(source), PAGES_AT_ONCE):
            out += main_texts([read_page(s) for s in source.iloc[i : i + PAGES_AT_ONCE]], model)
        return pd.Series(out, dtype=object)

    return (pages.select("page_id", "url", text("html").alias("text"))
                 .withColumn("n_chars", F.char_length("text").cast("long")))
