"""Main text of pages by a tree-structured graphical model.

The variables are the elements of a page, content or not. Each has a potential over its features, each
pair of parent and child one over their two labels. Sum-product messages go up and down the tree once and
give the exact marginals; training climbs the likelihood of labelled pages with the same messages. Text
whose element is more likely content than not is the main text.

Defined cases: a null or empty page, and one without content, has an empty text; markup that is cut off ends
with the page; pages that repeat are read each; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches, dom

STEPS = 300
RATE = 0.3
PENALTY = 1e-3

# Element groups, and words in class, id and role names, each a feature.
TAG_GROUPS = [
    "article main", "nav menu", "header", "footer", "aside", "form button fieldset label legend input dialog",
    "p blockquote pre figure figcaption details summary", "h1 h2 h3 h4 h5 h6 hgroup", "ul ol dl", "li dt dd",
    "table thead tbody tfoot tr td th caption", "div section center", "a", "html body",
    "b i em strong u s small span font mark code sub sup q cite abbr time tt kbd",
]
NAME_GROUPS = [
    "article content main post entry story text prose body",
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc skip topbar toolbar tabs",
    "header masthead banner hero logo branding contentinfo top",
    "footer foot bottom copyright legal colophon imprint",
    "sidebar side aside rail widget widgets complementary secondary related recommended recommendations trending popular more",
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo promotion promoted adsense adslot dfp taboola outbrain",
    "cookie cookies consent gdpr notice notices alert popup modal overlay paywall banner message notification privacy",
    "newsletter subscribe subscription signup login register search form share sharing social follow",
    "comment comments commentlist respond reply replies disqus discussion feedback reviews",
]
_TAGS = {tag: k for k, group in enumerate(TAG_GROUPS) for tag in group.split()}
_NAMES = [frozenset(group.split()) for group in NAME_GROUPS]
_WORD = re.compile(r"[a-z]+")
_STATISTICS = 9
_ARTICLE, _OTHER_TAGS = 0, (1, 3, 4, 5)
FEATURES = 1 + len(TAG_GROUPS) + 1 + len(NAME_GROUPS) + _STATISTICS
# Potentials of parent and child labels, apart for four kinds of children.
CHILD_KINDS = 4


@lru_cache(maxsize=50_000)
def _name_features(names: str) -> tuple[int, ...]:
    found = set(_WORD.findall(names.lower().replace("adv-", "advert ")))
    return tuple(k for k, group in enumerate(_NAMES) if found & group)


@dataclass
class Forest:
    """The elements of several pages: features, parent (-1 for pages), child kind, and elements by depth."""

    x: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]


def forest(pages: list[dom.Page]) -> Forest:
    sizes = [len(p.tags) for p in pages]
    starts = np.cumsum([0, *sizes])
    n = int(starts[-1])
    parent, depth = np.empty(n, np.int64), np.empty(n, np.int64)
    x, kind = np.zeros((n, FEATURES)), np.full(n, 3)
    chars, linked, ends = np.zeros(n), np.zeros(n), np.zeros(n)
    rows, columns = [], []
    for page, start in zip(pages, starts.tolist(), strict=False):
        end = start + len(page.tags)
        parent[start:end] = page.parents
        parent[start + 1 : end] += start
        depth[start:end] = page.depths
        for k, (tag, names) in enumerate(zip(page.tags, page.names, strict=True), start):
            group = _TAGS.get(tag, len(TAG_GROUPS))
            rows.append(k)
            columns.append(1 + group)
            kind[k] = 0 if group in (6, 7, 14) else 1 if group in (8, 9, 10, 12) else 2 if group in (11, 13) else 3
            if names:
                for f in _name_features(names):
                    rows.append(k)
                    columns.append(2 + len(TAG_GROUPS) + f)
                    kind[k] = 3
        for _, element, text in page.pieces:
            size = len(text) - text.count(" ")
            if size:
                chars[start + element] += size
                ends[start + element] += text.count(".") + text.count(",")
                if page.tags[element] == "a":
                    linked[start + element] += size
    x[:, 0] = 1
    x[rows, columns] = 1
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for level in reversed(levels[1:]):
        for total in (chars, linked, ends):
            np.add.at(total, parent[level], total[level])
    base = FEATURES - _STATISTICS
    x[:, base] = np.minimum(np.log1p(chars) / 8, 1.5)
    x[:, base + 1] = linked / np.maximum(chars, 1)
    x[:, base + 2] = np.minimum(20 * ends / np.maximum(chars, 1), 1.5)
    x[:, base + 3] = chars > 100
    x[:, base + 4] = chars == 0
    x[:, base + 5] = parent < 0
    # What encloses an element, itself included: an article, something that is none; and articles elsewhere on the page.
    names = x[:, 2 + len(TAG_GROUPS) : base]
    inside = x[:, 1 + _ARTICLE].copy()
    other = np.maximum(x[:, [1 + k for k in _OTHER_TAGS]].max(axis=1), names[:, 1:].max(axis=1))
    for level in levels[1:]:
        inside[level] = np.maximum(inside[level], inside[parent[level]])
        other[level] = np.maximum(other[level], other[parent[level]])
    page = np.repeat(np.arange(len(sizes)), sizes)
    proper = np.zeros(len(sizes))
    np.maximum.at(proper, page, inside * (1 - other))
    x[:, base + 6], x[:, base + 7] = inside * (1 - other), other
    x[:, base + 8] = (1 - inside) * proper[page]
    return Forest(x, parent, kind, levels)


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


@dataclass
class Model:
    """Weights of the element features (for content) and of the label pairs, [kind, parent, child]."""

    node: np.ndarray
    edge: np.ndarray

    def messages(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Log marginals of the elements, and of (parent, child) pairs, by one pass up and one down."""
        n = len(f.parent)
        own = np.stack([np.zeros(n), f.x @ self.node], axis=1)
        below = own.copy()
        up = np.zeros((n, 2))
        pair = self.edge[f.kind]
        for level in reversed(f.levels[1:]):
            up[level] = _added(pair[level, :, 0] + below[level, None, 0], pair[level, :, 1] + below[level, None, 1])
            np.add.at(below, f.parent[level], up[level])
        belief = below.copy()
        joint = np.zeros((n, 2, 2))
        for level in f.levels[1:]:
            rest = belief[f.parent[level]] - up[level]
            joint[level] = rest[:, :, None] + pair[level] + below[level, None, :]
            belief[level] = _added(joint[level, 0, :], joint[level, 1, :])
        belief -= _added(belief[:, 0], belief[:, 1])[:, None]
        joint -= np.logaddexp.reduce(joint.reshape(n, 4), axis=1)[:, None, None]
        return belief, joint

    def content(self, f: Forest) -> np.ndarray:
        """Marginal probability of each element to be content."""
        return np.exp(self.messages(f)[0][:, 1])


def labels_of(page: dom.Page) -> np.ndarray:
    """Labels from marks: an element without one has its parent's; the page itself is no content."""
    out = np.zeros(len(page.tags), np.int64)
    for k in range(1, len(out)):
        mark = page.marks[k]
        out[k] = out[page.parents[k]] if mark is None else int(mark == "main")
    return out


def train(labelled: Iterable[str], mark: str = "data-label", steps: int = STEPS) -> Model:
    """Fit on labelled pages: an element marked ``main`` is content with all below it, one marked otherwise is not."""
    pages = [dom.parse(p, mark) for p in labelled]
    f = forest(pages)
    y = np.concatenate([labels_of(p) for p in pages])
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros((CHILD_KINDS, 2, 2))
    np.add.at(seen, (f.kind[child], y[f.parent[child]], y[child]), 1)
    model = Model(np.zeros(FEATURES), np.zeros((CHILD_KINDS, 2, 2)))
    squares = [np.zeros_like(model.node), np.zeros_like(model.edge)]
    for _ in range(steps):
        belief, joint = model.messages(f)
        node = f.x.T @ (y - np.exp(belief[:, 1])) / len(y) - PENALTY * model.node
        expected = np.zeros_like(seen)
        np.add.at(expected, f.kind[child], np.exp(joint[child]))
        edge = (seen - expected) / len(y) - PENALTY * model.edge
        for weights, slope, square in ((model.node, node, squares[0]), (model.edge, edge, squares[1])):
            square += slope**2
            weights += RATE * slope / np.sqrt(square + 1e-12)
    return model


def texts(pages: list[str | None], model: Model) -> list[str]:
    """Main text of each page: its content blocks in page order, one a line."""
    parsed = [dom.parse(p) for p in pages]
    f = forest(parsed)
    good = model.content(f) > 0.5
    out, start = [], 0
    for page in parsed:
        blocks: dict[int, list[str]] = {}
        for block, element, text in page.pieces:
            if good[start + element]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        out.append("\n".join(line for line in lines if line))
        start += len(page.tags)
    return out


def main_text(pages: DataFrame, model: Model, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    plain = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))

    def make(bodies: list) -> list[list]:
        found = []
        for a, b in batches.slices([len(h or "") for h in bodies], 1 << 20):
            found += texts(bodies[a:b], model)
        return [found, [len(t) for t in found]]

    return batches.with_columns(plain, "html", [("text", "string"), ("n_chars", "long")], make).drop("html")
