"""Pages as trees of elements with the text pieces they hold, read leniently."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

_TAG = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<(?P<other>[!?])[^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

# Elements by what the page language says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
# Scripts, styles and form fields; the rest is left to the reader of the tree.
HIDDEN = RAW | frozenset("head select datalist".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# An opening element ends an open one of these, unless one of the fences lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "body": (("head",), ("body",)),
}
# An open select or datalist ends at elements that cannot stand in it.
_ENDS_FIELD = (BLOCK | frozenset("input textarea select datalist".split())) - frozenset("option optgroup hr legend".split())
_ENDS_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr option optgroup legend".split())
_P_FENCES = frozenset("button table td th caption html object".split())


@dataclass
class Page:
    """Elements in page order; the first is the page itself. ``pieces`` has (block, element, text) in page order."""

    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    depths: list[int] = field(default_factory=lambda: [0])
    names: list[str] = field(default_factory=lambda: [""])
    marks: list[str | None] = field(default_factory=lambda: [None])
    pieces: list[tuple[int, int, str]] = field(default_factory=list)


def parse(page: str | None, mark: str | None = None) -> Page:
    """Read a page. ``mark`` names an attribute that is kept per element, such as a label."""
    out = Page()
    if not page:
        return out
    stack, block, hidden, at, size = [0], 0, 0, 0, len(page)
    # Where in the stack the open elements of a name are, so that no tag looks through all that is open.
    places: defaultdict[str, list[int]] = defaultdict(list)
    tags, parents, depths, names, marks, pieces = out.tags, out.parents, out.depths, out.names, out.marks, out.pieces

    def close(down_to: int) -> None:
        nonlocal block, hidden
        while len(stack) > down_to:
            tag = tags[stack.pop()]
            places[tag].pop()
            block += tag in BLOCK
            hidden -= tag in HIDDEN

    def innermost(kinds) -> int:
        return max((places[kind][-1] for kind in kinds if places.get(kind)), default=0)

    def end_open(kinds, fences) -> None:
        last = innermost(kinds)
        if last > innermost(fences):
            close(last)

    while at < size:
        found = _TAG.search(page, at)
        start = found.start() if found else size
        if start > at and tags[stack[-1]] == "head" and not page[at:start].isspace():
            close(len(stack) - 1)
        if start > at and not hidden:
            pieces.append((block, stack[-1], html.unescape(page[at:start])))
        if not found:
            break
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        tag = name.lower()
        if found["close"] or found["close2"]:
            if places.get(tag):
                close(places[tag][-1])
            else:
                block += tag in BLOCK
            continue
        if hidden and tag not in IN_HEAD:
            end_open(("head",), ("template",))
        if hidden and tag in _ENDS_FIELD:
            end_open(("select", "datalist"), ())
        if tag in _ENDS_P:
            end_open(("p",), _P_FENCES)
        if tag in ENDS:
            end_open(*ENDS[tag])
        if tag in BLOCK:
            block += 1
        if tag in VOID:
            if tag == "br" and not hidden:
                pieces.append((block, stack[-1], " "))
            continue
        rest = found["rest"] if found["name"] else found["rest2"]
        kept, marked = [], None
        if "=" in rest:
            for key, *values in _ATTRIBUTE.findall(rest):
                key = key.lower()
                if key in ("class", "id", "role"):
                    kept.append("".join(values))
                elif key == mark:
                    marked = "".join(values)
        tags.append(tag)
        parents.append(stack[-1])
        depths.append(len(stack))
        names.append(" ".join(kept))
        marks.append(marked)
        if rest.endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        places[tag].append(len(stack))
        stack.append(len(tags) - 1)
        hidden += tag in HIDDEN
    return out
