"""A forgiving HTML reader that yields a page's block tree.

Nodes are block-level elements in page order; a block is the text of one
stretch without block boundaries, owned by the innermost open node.  Inline
elements and line breaks do not end a block.  The content of scripts, styles
and the like is dropped, character references are decoded, and white space in a
block becomes one space.  Unclosed and stray tags are closed and ignored as
browsers do in the common cases (paragraphs, list items, table parts).

Only elements whose content HTML reads as plain characters (scripts, styles,
titles) run to the end of the page when unclosed.  Graphics and media are
dropped up to their own end tag; a start tag without one drops nothing.  An
open head ends at the first text or element of the body.  Objects and noscript
elements are nodes, except inside a paragraph, heading or inline element;
formulas are inline.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by their role in HTML.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
# Dropped up to their own end tag, if they have one.
EMBEDDED = frozenset("template svg canvas audio video iframe".split())
# Elements whose content is never text of the page: dropped with everything inside.
SILENT = RAW | {"head", "select", "button", "datalist"}
# Nodes where block-level elements can stand, else inline.
EITHER = frozenset("object noscript".split())
# End tags that close open blocks above their element.
_CROSSING = BLOCK | SILENT | EITHER | EMBEDDED
_PHRASING = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
# Elements that do not end an open head.
HEAD = RAW | frozenset("html head base basefont bgsound link meta noscript template".split())
# A start tag of the first kind ends an open element of the second, inside the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
          "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)", re.I)
_WORD = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Nodes in page order (node 0 is the root) and their blocks."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tokens: list[frozenset] = field(default_factory=lambda: [frozenset()])
    fields: list[int] = field(default_factory=lambda: [0])  # form fields and images directly inside
    block_node: list[int] = field(default_factory=list)
    block_text: list[str] = field(default_factory=list)
    block_link: list[int] = field(default_factory=list)  # characters inside links


def attribute_tokens(attributes: str) -> frozenset:
    """Lower-case words of class, id and role."""
    if not attributes:
        return frozenset()
    return frozenset(w.lower() for m in _ATTR.finditer(attributes) for w in _WORD.findall(_CAMEL.sub(" ", m[2])))


def _ends(name: str, source: str) -> dict[int, int]:
    """Start and end of each ``name`` element that has its own end tag."""
    out, open_at = {}, []
    for m in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", source, re.I):
        if not m[1]:
            if not m[2].endswith("/"):
                open_at.append(m.start())
        elif open_at:
            out[open_at.pop()] = m.end()
    return out


def read_page(source: str | None) -> Page:
    page = Page()
    source = source or ""
    stack: list[tuple[str, int, bool]] = [("#root", 0, False)]  # name, node, silent
    parts: list[str] = []
    link = 0

    def flush(node: int) -> None:
        nonlocal link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.block_node.append(node)
                page.block_text.append(text)
                page.block_link.append(link)
            parts.clear()
        link = 0

    def close(to: int) -> None:
        """Close the elements above position ``to`` of the stack."""
        while len(stack) > to:
            _, node, _ = stack.pop()
            if node != stack[-1][1]:
                flush(node)

    def end_head() -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == "head":
                close(i)
                return

    ends: dict[str, dict[int, int]] = {}
    links = 0  # open <a> elements
    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        text = source[at : m.start() if m else end]
        if stack[-1][0] == "head" and text.strip():
            end_head()
        if text and not stack[-1][2]:
            text = html.unescape(text)
            parts.append(text)
            if links:
                link += len(text.strip())
        if not m:
            break
        at = m.end()
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if slash:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in BLOCK and name not in _CROSSING:
                    break
            links = sum(e[0] == "a" for e in stack) if name == "a" or links else 0
            continue
        if stack[-1][2] and name not in HEAD:
            end_head()
        silent = stack[-1][2]
        if name in EMBEDDED:
            if name not in ends:
                ends[name] = _ends(name, source)
            at = ends[name].get(m.start(), at)
            continue
        if name in RAW and not attributes.endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*+>?", re.I).search(source, at)
            at = stop.end() if stop else end
            continue
        flow = stack[-1][0] == page.tag[stack[-1][1]] and stack[-1][0] not in _PHRASING and not silent
        if name in BLOCK or (name in EITHER and flow and not attributes.endswith("/")):
            rule = CLOSES.get(name)
            if rule:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in rule[0]:
                        close(i)
                        if name in ("li", "dt", "dd", "td", "th", "option"):
                            break
                    elif stack[i][0] in rule[1]:
                        break
            elif name not in ("option", "optgroup"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            links = sum(e[0] == "a" for e in stack) if links else 0
            flush(stack[-1][1])
            if name == "hr":
                continue
            page.tag.append(name)
            page.parent.append(stack[-1][1])
            page.depth.append(page.depth[stack[-1][1]] + 1)
            page.tokens.append(attribute_tokens(attributes))
            page.fields.append(0)
            stack.append((name, len(page.tag) - 1, silent or name in SILENT))
        elif name == "br":
            parts.append(" ")
        elif name in VOID:
            if name in ("input", "img", "embed"):
                page.fields[stack[-1][1]] += 1
        elif not attributes.endswith("/"):
            stack.append((name, stack[-1][1], silent or name in SILENT))
            links += name == "a"
    close(1)
    flush(0)
    return page
