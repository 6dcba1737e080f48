"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of items: words, which score positive in running text, and tags, which
score negative.  A word's score is its log odds of being main text, given the elements
it stands in and what their class, id or role says; a logistic regression learns it
from labelled pages, as it learns each tag's share outside of main text.  One linear
scan finds the contiguous run of items with the largest sum, and this run alone decides
where the main text begins and ends.  Between its words, elements of the kinds that are
no part of an article (adverts, comments, asides, menus) are left out where their own
items sum up below zero; forms, scripts and what isn't shown hold no words at all.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, column, slices

#: Elements by their part in a page, as the HTML standard names them.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Elements that hold no running text.
WORDLESS = frozenset("head form script style noscript template iframe button select option textarea input label svg math canvas object audio video map fieldset noembed noframes title".split())
#: Elements that may be left out of the run, as those with MARKS may.
ASIDE = frozenset("nav aside header footer menu dialog search".split())
#: Words in a class, id or role that tell of adverts, comments, menus and the like; what they weigh is learned.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion promoted comment comments commentlist disqus respond reply replies discussion sidebar aside widget rail related recommended recommendations readmore trending popular menu navbar navigation nav breadcrumb breadcrumbs pagination pager footer colophon copyright masthead topbar toolbar header cookie cookies consent gdpr notice notices alert warning popup modal overlay newsletter subscribe subscription signup login share sharing social follow tags skip toc search complementary contentinfo dialog paywall".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
_OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?]|<(/?)([A-Za-z][^\s/><\"']*)", re.S)
_ENDS = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_WHITE = re.compile(r"\s+")
#: Elements that an opening tag of the same kind, or of one of the others, ends.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: What a tag costs that is never inside main text.
TAG = 0.3
#: Labels: main text, and what in it is no main text.
LABELS = {"<!--[-->": 1, "<!--]-->": -1, "<!--{-->": -1, "<!--}-->": 1}
#: Open elements beyond which an end tag or a new item doesn't look for the one it ends.
BOUNDS = frozenset("ul ol dl table select article section div td th blockquote".split())
_EMPTY: frozenset[str] = frozenset()
_MAIN = frozenset(["article", "main"])


@lru_cache(4096)
def _own(name: str, attributes: str) -> tuple[bool, bool, frozenset[str]]:
    """Of one element: whether it is not shown, whether it may be left out of the run, and its features."""
    hidden, marked, features = False, name in ASIDE, {name}
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key in ("class", "id", "role") and not (key == "id" and name in HEADINGS) and name not in ("html", "body"):
            sign = "#" if key == "id" else "."
            for word in value.split():
                parts = [x.lower() for x in _PART.findall(word)]
                features.update(sign + x for x in parts)
                if any(x in MARKS for x in parts):
                    features.add(sign + ("mark" if len(parts) == 1 else "part mark"))
                    marked = True
    return hidden, marked, frozenset(features)


@lru_cache(65536)
def _joined(outer: frozenset[str], own: frozenset[str]) -> frozenset[str]:
    return outer | own


def items(page: str) -> list[tuple[str, str, str, bool, int, frozenset[str]]]:
    """The page's items as ``_scan`` gives them.

    A wrapper may bear a name such as ``with-sidebar``: the names of an element that
    holds most of the page's running words don't count, unless they tell of comments.
    """
    marked: list[tuple[int, frozenset[str]]] = [(0, _EMPTY)]
    found = list(_scan(page, marked))
    words = [0] * len(marked)
    for kind, _, text, wordless, e, features in found:
        if kind == "text" and not wordless and "a" not in features:
            words[e] += len(text.split())
    total = sum(words)
    for e in range(len(marked) - 1, 0, -1):
        words[marked[e][0]] += words[e]
    freed = [_EMPTY] * len(marked)  # features that don't count within each element
    for e in range(1, len(marked)):
        outer, own = marked[e]
        names = frozenset(f for f in own if f[0] in ".#")
        wrapper = 2 * words[e] > total and not any(f[1:] in COMMENTS for f in names)
        freed[e] = freed[outer] | names if wrapper else freed[outer]
    if not any(freed):
        return found
    return [(kind, key, text, wordless, e, features - freed[e] if freed[e] else features) for kind, key, text, wordless, e, features in found]


class _Ends:
    """Where tags end: for each ``>`` and quote of the page, the ``>`` that ends a tag which reaches it outside of quotes; made once, from the back."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _ENDS.finditer(page)]
        self.end = [-1] * (len(self.at) + 1)
        behind: dict[str, int] = {}
        for i in range(len(self.at) - 1, -1, -1):
            c = page[self.at[i]]
            if c == ">":
                self.end[i] = self.at[i]
            else:
                if c in behind:
                    self.end[i] = self.end[behind[c] + 1]
                behind[c] = i

    def after(self, at: int) -> int:
        """The end of a tag that goes on at ``at``; -1 if it has none."""
        return self.end[bisect_left(self.at, at)]


@lru_cache(4096)
def _kinds(name: str) -> tuple[str, ...]:
    return name, *(kind for kind, names in (("+block", BLOCKS), ("+wordless", WORDLESS), ("+bound", BOUNDS)) if name in names)


class _Open:
    """The open elements, with the places of each name and kind, so that nothing is looked for by walking down."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int, frozenset[str]]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.wordless = 0

    def last(self, kind: str) -> int:
        return self.places[kind][-1] if self.places[kind] else -1

    def push(self, element: tuple[str, bool, int, frozenset[str]]) -> None:
        for kind in _kinds(element[0]):
            self.places[kind].append(len(self.stack))
        self.stack.append(element)
        self.wordless += element[1]

    def cut(self, depth: int) -> None:
        """Closes everything from a depth on."""
        while len(self.stack) > depth:
            name, wordless, *_ = self.stack.pop()
            self.wordless -= wordless
            for kind in _kinds(name):
                self.places[kind].pop()

    def around(self) -> tuple[int, frozenset[str]]:
        return (self.stack[-1][2], self.stack[-1][3]) if self.stack else (0, _EMPTY)


def _scan(page: str, elements: list[tuple[int, frozenset[str]]]) -> Iterator[tuple[str, str, str, bool, int, frozenset[str]]]:
    """The page's items in order: (kind, key, text, wordless, element, features).

    Kinds are ``text``, ``tag`` (key: the tag's name, with a slash if it closes) and
    ``label``.  ``wordless`` is true within elements that hold no running text or
    aren't shown.  ``element`` numbers the innermost element that may be left out of
    the run, 0 for none; its outer one has a smaller number.  ``features`` are those
    of all elements around the item.  ``elements`` receives for each such element its
    outer one and its own features.  What looks like a tag but never ends is text.  The
    scan only moves forward, so its time grows with the page whatever its markup.
    """
    open_, ends = _Open(), _Ends(page)
    at, look, n, around = 0, 0, len(page), open_.around
    last = page.rfind(">")
    while at < n:
        m = _OPEN.search(page, look)
        close = 0
        if m and (m[2] or m.end() == m.start() + 2):
            close = (ends.after(m.end()) if m[2] else page.find(">", m.end())) if m.end() <= last else -1
            if close < 0:
                look = m.end()
                continue
        end = m.start() if m else n
        if end > at:
            yield "text", "", page[at:end], open_.wordless > 0, *around()
        if not m:
            return
        at = look = close + 1 if close else m.end()
        if not m[2]:
            if m[0] in LABELS:
                yield "label", m[0], "", False, *around()
            continue
        name, closing, attributes = m[2].lower(), bool(m[1]), page[m.end() : close]
        if closing:
            depth = open_.last(name)
            yield "tag", "/" + name, "", open_.wordless > 0, *around()
            if depth >= 0 and not (name not in BLOCKS and open_.last("+wordless") > depth):
                open_.cut(depth)
            continue
        for x in _CLOSES.get(name, ()):
            depth = open_.last(x)
            if depth >= 0 and open_.last("+bound") <= depth:
                open_.cut(depth)
        if name in BLOCKS and name != "p":  # a block ends an open paragraph
            depth = open_.last("+block")
            if depth >= 0 and open_.stack[depth][0] == "p":
                open_.cut(depth)
        hidden, marked, own = _own(name, attributes)
        element, features = around()
        if marked:
            elements.append((element, own))
            element = len(elements) - 1
        features = _joined(features, own)
        yield "tag", name, "", open_.wordless > 0, element, features
        if name in VOID or attributes.rstrip().endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = look = found.end() if found else n
            yield "tag", "/" + name, "", True, element, features
            continue
        open_.push((name, hidden or name in WORDLESS, element, features))


def _beside_main(found: list) -> list[bool]:
    """Which items stand outside of ``article`` and ``main`` elements, on a page where these hold most of the running words.

    Words of elements that may be left out don't count against them.
    """
    inside = [bool(_MAIN & x[5]) for x in found]
    words = [0, 0]
    for (kind, _, text, wordless, e, features), is_in in zip(found, inside):
        if kind == "text" and not wordless and "a" not in features and (is_in or not e):
            words[is_in] += len(text.split())
    return [not x for x in inside] if words[1] > words[0] else [False] * len(found)


class Weights:
    """What words and tags score, learned from labelled pages."""

    def __init__(self, pages: Iterable[str], strength: float = 0.02, steps: int = 30):
        counts: dict[tuple[frozenset[str], bool], list[float]] = defaultdict(lambda: [0.0, 0.0])
        tags: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for page in pages:
            found, label = items(page), 0
            total = sum(len(x[2].split()) for x in found if x[0] == "text" and not x[3])
            for (kind, key, text, wordless, _, features), beside in zip(found, _beside_main(found)):
                if kind == "label":
                    label += LABELS[key]
                elif kind == "tag":
                    tags[key.strip("/")][label] += 1
                elif not wordless and text.strip():
                    counts[features, beside][label] += math.sqrt(len(text.split())) * 100 / max(total, 1)  # pages weigh alike
        names = sorted({f for features, _ in counts for f in features})
        self.place = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(counts), len(names) + 2))
        for row, (features, beside) in zip(x, counts):
            row[[self.place[f] for f in features]] = 1
            row[-2:] = beside, 1
        y = np.array(list(counts.values())).reshape(-1, 2)
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), strength * 100)
        ridge[-1] = 1e-6
        for _ in range(steps):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (y[:, 1] - y.sum(axis=1) * p) - ridge * w
            curve = (x.T * (y.sum(axis=1) * p * (1 - p))) @ x + np.diag(ridge)
            w += np.linalg.solve(curve, gradient)
        self.weight, self.beside, self.bias = dict(zip(names, w.tolist())), float(w[-2]), float(w[-1])
        self.tag = {name: -TAG * (out + 0.5) / (out + own + 1) for name, (out, own) in tags.items()}
        self.known: dict[frozenset[str], float] = {}

    def word(self, features: frozenset[str], beside: bool) -> float:
        """What each word with these features scores."""
        if features not in self.known:
            if len(self.known) > 65536:
                self.known.clear()
            self.known[features] = self.bias + sum(sorted(self.weight[f] for f in features if f in self.weight))
        return self.known[features] + beside * self.beside

    def scores(self, found: list) -> list[float]:
        """What each item scores; nothing inside elements that hold no running text."""
        out = []
        for (kind, key, text, wordless, _, features), beside in zip(found, _beside_main(found)):
            if wordless or kind == "label" or key.strip("/") in WORDLESS:
                out.append(0.0)
            elif kind == "tag":
                out.append(self.tag.get(key.strip("/"), -TAG / 2))
            else:
                out.append(self.word(features, beside) * len(text.split()))
        return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the largest sum (the first of equals); empty if none is positive."""
    best, begin, end, run, start = 0.0, 0, 0, 0.0, 0
    for i, x in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += x
        if run > best:
            best, begin, end = run, start, i + 1
    return begin, end


def _left_out(found: list, scores: list[float]) -> set[int]:
    """Elements of the run that have main text before and after them and items that sum up below zero."""
    outer: dict[int, int] = {0: 0}
    total: dict[int, float] = defaultdict(float)
    span: dict[int, list[int]] = {}
    stack = [0]
    for i, ((_, _, _, _, e, _), x) in enumerate(zip(found, scores)):
        while stack[-1] > e:
            stack.pop()
        if stack[-1] != e:
            outer[e] = stack[-1]
            stack.append(e)
        if e:
            total[e] += x
            span.setdefault(e, [i, i])[1] = i
    for e in sorted(span, reverse=True):  # inner elements have larger numbers
        if outer[e]:
            total[outer[e]] += total[e]
            wide = span.setdefault(outer[e], list(span[e]))
            wide[:] = min(wide[0], span[e][0]), max(wide[1], span[e][1])
    words = [i for i, (x, s) in enumerate(zip(found, scores)) if x[0] == "text" and s > 0]
    gone: set[int] = set()
    for e in sorted(span):
        enclosed = bool(words) and words[0] < span[e][0] and words[-1] > span[e][1]
        if outer[e] in gone or (total[e] < 0 and enclosed):
            gone.add(e)
    return gone


def extract(page: str, weights: Weights) -> str:
    """The main text of one page."""
    found = items(page)
    scores = weights.scores(found)
    a, b = best_run(scores)
    found, scores = found[a:b], scores[a:b]
    gone = _left_out(found, scores)
    blocks: list[list[str]] = [[]]
    for kind, key, text, wordless, e, _ in found:
        if kind == "text":
            if not wordless and e not in gone:
                blocks[-1].append(text)
        elif kind == "tag" and key.strip("/") in BLOCKS:
            blocks.append([])
        elif key == "br":
            blocks[-1].append(" ")
    text = (_WHITE.sub(" ", entities.unescape("".join(x))).strip() for x in blocks)
    return "\n".join(x for x in text if x)


def labelled_pages() -> list[str]:
    """Pages of several layouts, marked by hand with LABELS."""
    return (Path(__file__).parent / "labelled_pages.html").read_text(encoding="utf-8").split("\n=====\n")


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), labelled: list[str] | None = None) -> DataFrame:
    """``id_col``, ``keep``, ``text`` and ``n_chars`` (code points) for each page.

    Blocks of the main text are joined by a line feed, white space in a block is one
    space, character references are decoded.  A null or empty page, and one without
    words, gives the empty text; null ids and repeated rows are passed on.  Other
    columns are ignored, whatever their names.  A page is read whole, whatever its
    length; no shuffle.  ``labelled`` pages carry LABELS as comments.
    """
    weights = Weights(labelled or labelled_pages())
    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    names = ["id", *[f"keep{i}" for i in range(len(keep))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                text = [extract(x or "", weights) for x in column(part, "html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[column(part, n) for n in names], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=[*names, "text", "n_chars"])

    chosen = pages.select(col(id_col).alias("id"), *[col(k).alias(f"keep{i}") for i, k in enumerate(keep)], col(html_col).alias("html"))
    out = chosen.mapInArrow(run, ", ".join(f"{n} {fields[k]}" for n, k in zip(names, [id_col, *keep])) + ", text string, n_chars long")
    for n, k in zip(names, [id_col, *keep]):
        out = out.withColumnRenamed(n, k)
    return out
