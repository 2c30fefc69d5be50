"""Operator 3, main text of HTML pages by a tree-structured graphical model.

A page becomes a tree of its block elements; every run of inline text between block boundaries is a leaf (a *block*). Each node is content or
not. The model has a potential per node (tag, hint in class, id or role, text length, share of linked text, ending, depth) and one per edge
(label of the parent, label of the child, leaf or not). Messages are passed from the leaves to the root and back (sum-product, exact on a
tree) and give each leaf its marginal; leaves above one half are the text, in page order. Pages of a batch run side by side, depth by depth.

Potentials are log counts from labelled pages: those that mark their main part (``article``, ``main`` or the matching role). Inside it nodes are
content, but for parts whose tag or hint says otherwise; outside they are not. Every such
page counts half as it is and half as if its main part had no mark. Counts are summed over partitions. At most about
``TRAINING_PAGES`` pages are learnt from, chosen by a hash of ``page_id``; every page is extracted. A few counts given beforehand keep pages
without labels sensible.

Null html is empty and gives an empty text. Character references are decoded, white space becomes one space, blocks are joined by a line
break. Rows are independent; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from penmark.llm.common import arrow

TRAINING_PAGES = 20_000
# The elements of HTML by their role.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset
h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead
tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea"  # all up to the end tag, or to the end of the page
HIDDEN = "noscript|template|svg|iframe|object|canvas|button"  # without text of the page, if they are closed; an open one ends at once
NOISE_TAGS = frozenset("nav header footer aside form fieldset menu dialog select option optgroup legend".split())
MAIN_TAGS = frozenset(("article", "main"))
NOISE_WORDS = frozenset("""ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
breadcrumbs header masthead footer sidebar side aside widget related recommended share sharing social comment comments reply replies disqus
respond cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup login form search toolbar pager
pagination tags meta copyright legal skip hidden complementary contentinfo dialog""".split())
_UNSURE = frozenset("header masthead meta tags hidden alert".split())  # names that parts of the main text have too
# Names of a layout, such as "with-sidebar" or "share-enabled", say nothing about what the part itself is.
LAYOUT_WORDS = frozenset("with without has have no is enabled disabled layout wrapper wrap container page site".split())
ASIDE_WORDS = frozenset("comment comments reply replies disqus respond".split())  # may be longer than the article
WHOLE = 0.6  # a part with more of the page's text than this is a container, whatever it is called
MAIN_WORDS = frozenset("article main content entry post story body text articlebody".split())
TAGS = sorted({"heading" if re.fullmatch("h[1-6]", t) else t for t in BLOCKS})
TRUST = 0.5  # features of a node repeat each other, so their log counts are tempered

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(?P<raw>" + RAW + r")\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<hidden>" + HIDDEN + r")\b[^>]*+>(?:(?!<(?P=hidden)\b).)*?</(?P=hidden)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Features of a node and the number of values of each.
SIZES = (len(TAGS) + 1, 3, 14, 6, 3, 8)
FEATURES = len(SIZES)
_STARTS = np.concatenate(([0], np.cumsum(SIZES)))


def _words(rest: str) -> set[str]:
    """The words of class, id and role. A name that holds a layout word gives none, unless it is a main word alone."""
    out: set[str] = set()
    for found in _NAMES.findall(rest):
        for name in "".join(found).split():
            words = {w.lower() for w in _WORD.findall(name)}
            out |= words & ASIDE_WORDS if words & LAYOUT_WORDS else words
    return out


def _hint(words: set[str]) -> int:
    """0: nothing said, 1: names of a part that is not the main text, 2: names of the main text."""
    main = bool(words & MAIN_WORDS)
    return 1 if words & (NOISE_WORDS - _UNSURE if main else NOISE_WORDS) else 2 if main else 0


class Page:
    """The nodes of a page: parents before children, leaves carry text."""

    def __init__(self, source: str):
        self.parent, self.depth, self.values, self.label, self.text = [-1], [0], [(len(TAGS), 0, 13, 5, 2, 0)], [0], [None]
        self.hint, self.own = [0], [(0, False, False)]
        self.marked = False
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.run: list[str] = []
        self.linked, self.in_link = 0, 0
        at = 0
        for token in _TOKEN.finditer(source):
            self._inline(source[at : token.start()])
            at = token.end()
            tag = token["tag"] or token["tag2"]
            if tag:
                tag = tag.lower()
                if token["end"] or token["end2"]:
                    self._close(tag)
                else:
                    self._open(tag, token["rest"] or token["rest2"] or "")
        self._inline(source[at:])
        self._leaf()
        self._settle()

    def _settle(self) -> None:
        """A part named or tagged as noise that holds most of the page's text is its container: nothing is said by it or handed down."""
        size = [len(t or "") for t in self.text]
        for k in range(len(size) - 1, 0, -1):
            size[self.parent[k]] += size[k]
        if not any(own == 1 and loose and size[k] > WHOLE * size[0] for k, (own, loose, _) in enumerate(self.own)):
            return
        for k in range(1, len(size)):
            own, loose, main = self.own[k]
            tag, _, *rest = self.values[k]
            if own == 1 and loose and size[k] > WHOLE * size[0]:
                own, tag = 0, _TAG_OF["div"]
            self.hint[k] = self._handed(own, main, self.hint[self.parent[k]])
            self.values[k] = (tag, self.hint[k], *rest)

    @staticmethod
    def _handed(own: int, main: bool, above: int) -> int:
        """A part's hint holds for what is in it, until a main part starts. Names of the main text inside another part leave it open."""
        return own if main else (0 if own == 2 else 1) if above == 1 else own or above

    def _inline(self, text: str) -> None:
        if text:
            self.run.append(text)
            if self.in_link:
                self.linked += len(text.strip())

    def _add(
        self, tag: int, hint: int, rest: tuple[int, int, int], label: int, text: str | None, main: bool = False, loose: bool = False
    ) -> int:
        parent = self.stack[-1][1]
        depth = self.depth[parent] + 1
        self.parent.append(parent)
        self.depth.append(depth)
        self.own.append((hint, loose, main))
        hint = self._handed(hint, main, self.hint[parent])
        self.hint.append(hint)
        self.values.append((tag, hint, *rest, min(depth, 7)))
        self.label.append(label)
        self.text.append(text)
        return len(self.parent) - 1

    def _leaf(self) -> None:
        if not self.run:
            return
        text = " ".join(html.unescape("".join(self.run)).split())
        if text:
            share = min(4, int(4 * self.linked / len(text)))
            ending = 0 if text[-1] in ".!?…\"”»'" else 1
            tag = self.stack[-1][0]
            # the tag of a leaf is that of the element around it
            self._add(_TAG_OF.get(tag, len(TAGS)), 0, (min(12, len(text).bit_length()), share, ending), self.label[self.stack[-1][1]], text)
        self.run, self.linked = [], 0

    def _open(self, tag: str, rest: str) -> None:
        if tag == "a":
            self.in_link += 1
        if tag == "br":
            self.run.append(" ")
        if tag == "hr":
            self._leaf()
        if tag not in BLOCKS:
            return
        self._leaf()
        self.in_link = 0
        while len(self.stack) > 1 and (self.stack[-1][0] == "p" or self.stack[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option")):
            self.stack.pop()
        words = _words(rest) if rest else set()
        hint, above = _hint(words), self.label[self.stack[-1][1]]
        if hint == 1 and (tag in MAIN_TAGS or tag in ("body", "html", "center")):
            hint = 0
        main = tag in MAIN_TAGS or "role=\"main\"" in rest or "articleBody" in rest
        self.marked |= main
        # The header of an article is part of it.
        noise = hint == 1 or tag in NOISE_TAGS and not (tag == "header" and (above or self.hint[self.stack[-1][1]] == 2))
        hint = 1 if noise and not main else 2 if main else hint
        loose = not words & ASIDE_WORDS and (tag == "form" or tag not in NOISE_TAGS)
        self.stack.append((tag, self._add(_TAG_OF[tag], hint, (13, 5, 2), int((above or main) and not noise), None, main, loose)))

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag not in BLOCKS:
            return
        self._leaf()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break


_TAG_OF = {t: TAGS.index("heading" if re.fullmatch("h[1-6]", t) else t) for t in BLOCKS}
_MAIN_VALUES = [_TAG_OF[t] for t in MAIN_TAGS]


def _batch(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parent, depth, feature rows, leaf marks and labels of the nodes of all pages, roots included."""
    shift = np.cumsum([0, *(len(p.parent) for p in pages)])
    parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, shift)])
    parent[shift[:-1]] = -1
    depth = np.concatenate([p.depth for p in pages])
    values = np.concatenate([np.array(p.values) for p in pages]) + _STARTS[:-1]
    leaf = np.array([t is not None for p in pages for t in p.text])
    return parent, depth, values, leaf.astype(np.int64), np.concatenate([p.label for p in pages])


class Potentials:
    """Log counts: ``node[feature value, label]`` and ``edge[leaf, parent label, child label]``."""

    def __init__(self, node: np.ndarray, edge: np.ndarray):
        share = np.vstack([node[a:b] / node[a:b].sum(axis=0) for a, b in zip(_STARTS[:-1], _STARTS[1:])])
        self.node = np.log(share) * TRUST
        self.node[_STARTS[1] : _STARTS[2]] /= TRUST  # what a part says of itself counts in full
        self.edge = np.log(edge / edge.sum(axis=2, keepdims=True))

    def marginals(self, parent: np.ndarray, depth: np.ndarray, values: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The chance of content of every node: sum-product up and down the trees."""
        own = self.node[values].sum(axis=1)
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        up = np.zeros((len(parent), 2))  # from a node to its parent
        belief = own.copy()  # own potential and the messages of the children
        for nodes in levels[:0:-1]:
            joint = self.edge[leaf[nodes]] + belief[nodes][:, None, :]
            up[nodes] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            np.add.at(belief, parent[nodes], up[nodes])
        for nodes in levels[1:]:
            above = belief[parent[nodes]] - up[nodes]  # complete by now, without this child's own message
            joint = above[:, :, None] + self.edge[leaf[nodes]]
            down = np.logaddexp(joint[:, 0], joint[:, 1])
            belief[nodes] += down - down.max(axis=1, keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def prior() -> tuple[np.ndarray, np.ndarray]:
    """Counts given beforehand."""
    node, edge = np.ones((_STARTS[-1], 2)), np.array([[[20.0, 1.0], [1.0, 20.0]]] * 2)
    for tag in NOISE_TAGS:
        node[_TAG_OF[tag], 0] += 5
    for tag in MAIN_TAGS:
        node[_TAG_OF[tag], 1] += 5
    node[_STARTS[1] + 1, 0] += 5
    node[_STARTS[1] + 2, 1] += 5
    node[_STARTS[2] : _STARTS[2] + 6, 0] += 3  # short blocks
    node[_STARTS[2] + 7 : _STARTS[2] + 13, 1] += 3  # long ones
    node[_STARTS[3] + 2 : _STARTS[3] + 5, 0] += 3  # linked ones
    return node, edge


def train(pages: DataFrame, most: int = TRAINING_PAGES) -> Potentials:
    """Potentials from the pages that mark their main part."""
    total = pages.count()
    part = max(1, total // most)
    chosen = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(part)) == 0).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, edge = np.zeros((_STARTS[-1], 2)), np.zeros((2, 2, 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = [Page(x or "") for x in batch.column("html").slice(at, 500).to_pylist()]
                found = [p for p in found if p.marked]
                if found:
                    parent, _, values, leaf, label = _batch(found)
                    plain = values.copy()  # the same pages as if their main part bore no mark: most pages of the web do not
                    plain[np.isin(plain[:, 0], _MAIN_VALUES), 0] = _TAG_OF["div"]
                    plain[plain[:, 1] == _STARTS[1] + 2, 1] = _STARTS[1]
                    for column in (*values.T, *plain.T):
                        np.add.at(node, (column, label), 0.5)
                    child = np.flatnonzero(parent >= 0)
                    np.add.at(edge, (leaf[child], label[parent[child]], label[child]), 1)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([np.concatenate([node.ravel(), edge.ravel()]).tobytes()])], names=["part", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [0], "sums": [sum(np.frombuffer(x) for x in pdf["sums"]).tobytes()]})

    sums = arrow(chosen, run, "part long, sums binary").withColumn("part", (F.spark_partition_id() % 64).cast("long"))
    node, edge = prior()
    for row in sums.groupBy("part").applyInPandas(add, "part long, sums binary").toLocalIterator():
        counted = np.frombuffer(row["sums"])
        node += counted[: node.size].reshape(node.shape)
        edge += counted[node.size :].reshape(edge.shape)
    return Potentials(node, edge)


def extract(pages: DataFrame, model: Potentials | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    model = model or train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [Page(x or "") for x in part.column("html").to_pylist()]
                parent, depth, values, leaf, _ = _batch(found)
                good = model.marginals(parent, depth, values, leaf) > 0.5
                texts, start = [], 0
                for page in found:
                    texts.append("\n".join(t for t, keep in zip(page.text, good[start : start + len(page.text)].tolist()) if keep and t))
                    start += len(page.text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return arrow(rows, run, "page_id long, url string, text string, n_chars long")
