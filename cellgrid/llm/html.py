"""Layout-aware text of web pages: a tree builder with implied tags, visibility rules, and a renderer.

The renderer keeps all visible text: blocks on lines of their own, paragraphs and headings between blank lines, list
items with marks and indentation, table cells in aligned columns, preformatted text as it is.
"""

from __future__ import annotations

import html as entities
import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe object audio video canvas svg math datalist noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
ENDS_P = BLOCK - {"body", "html", "li", "dd", "dt", "legend", "option", "optgroup"}
#: A start tag closes these open elements, looking no further than the elements after them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
#: Any other start tag, or text, closes an open head.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements that are nested deeper become siblings, as in browsers; what hides text does so at any depth.
DEEPEST = 512
#: Keywords of two properties of CSS. A declaration with another value doesn't count.
DISPLAY = frozenset("none block inline inline-block flow-root flex inline-flex grid inline-grid list-item contents table inline-table table-row table-cell table-row-group table-header-group table-footer-group table-column table-column-group table-caption ruby run-in initial inherit unset revert".split())
VISIBILITY = frozenset("visible hidden collapse initial inherit unset revert".split())

_MARK = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*+)[^>]*>?|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "flat", "kids", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.flat: dict[str, int] = {}  # open elements in it that became siblings, by tag


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def style_of(attrs: dict[str, str]) -> dict[str, str]:
    """display and visibility of a style attribute: the last declaration counts, but an important one before others."""
    out: dict[str, str] = {}
    if "style" in attrs:
        important = set()
        for declaration in _COMMENT.sub(" ", attrs["style"]).lower().split(";"):
            name, _, value = declaration.partition(":")
            name, value = name.strip(), value.strip()
            first = re.sub(r"\s*!\s*important$", "", value)
            if first.split(" ")[0] in {"display": DISPLAY, "visibility": VISIBILITY}.get(name, ()):
                if first != value:
                    important.add(name)
                elif name in important:
                    continue
                out[name] = first
    return out


def build(page: str) -> Node:
    root = Node("#root", {})
    stack, at = [root], 0

    def close(names, until=frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    while at < len(page):
        m = _MARK.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            if stack[-1].tag == "head" and _SPACE.sub("", text):
                stack.pop()
            stack[-1].kids.append(entities.unescape(text))
        if not m:
            break
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if stack[-1].flat.get(tag):
                stack[-1].flat[tag] -= 1
                continue
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].kids.append(Node("p", {}))
            close({tag}, {"table", "#root"} if tag not in ("table", "html", "body", "div", "section", "article") else frozenset())
        elif m[2]:
            tag = m[2].lower()
            if stack[-1].tag == "head" and tag not in IN_HEAD:
                stack.pop()
            if tag in ENDS_P:
                close({"p"}, {"table", "td", "th", "button", "li", "div", "caption"})
            if tag in CLOSES:
                names, until = CLOSES[tag]
                for _ in range(3 if tag in ("tr", "tbody", "thead", "tfoot") else 2 if tag == "optgroup" else 1):
                    close(names, until)
            if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr", {})
                stack[-1].kids.append(row)
                stack.append(row)
            node = Node(tag, _attributes(m[3] or ""))
            stack[-1].kids.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?|\Z", re.I).search(page, at)
                node.kids.append(entities.unescape(page[at : end.start()]) if tag in ("textarea", "title") else page[at : end.start()])
                at = end.end()
            elif tag not in VOID:
                # deeper than twice that, all stands in something hidden
                if len(stack) < DEEPEST or (len(stack) < 2 * DEEPEST and not visible(node)):
                    stack.append(node)
                else:
                    stack[-1].flat[tag] = stack[-1].flat.get(tag, 0) + 1
    return root


def _unhide(node: Node, painted: bool = True) -> bool:
    """Settles visibility, which is inherited: an unpainted element that holds a painted one stays, without its own text.
    Says whether anything of the node is painted."""
    own = style_of(node.attrs).get("visibility")
    unpainted = own in ("hidden", "collapse")
    painted = (painted or own == "visible") and not unpainted
    held = [_unhide(k, painted) for k in node.kids if isinstance(k, Node)]
    if painted:
        return True
    node.kids = [k for k in node.kids if isinstance(k, Node)]
    if any(held):
        if unpainted:
            node.attrs["style"] += ";visibility:inherit!important"
        node.attrs.pop("alt", None)
        node.attrs.pop("value", None)
        return True
    node.attrs["hidden"] = ""
    return False


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    style = style_of(a)
    return style.get("display") != "none" and style.get("visibility") not in ("hidden", "collapse")


def width_of(text: str) -> int:
    """Columns that a text takes: wide characters take two, marks that are set on others none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _number(text: str) -> int | None:
    """An integer as HTML reads it: white space, a sign and digits; what follows is ignored."""
    m = re.match(r"[ \t\n\r\f]*([+-]?[0-9]{1,18})", text)
    return int(m[1]) if m else None


class _Lines:
    """Text in lines; a blank line is owed between spaced blocks but not before the first."""

    def __init__(self):
        self.done: list[str] = []
        self.now, self.gap, self.space = "", False, False

    def text(self, s: str, keep: bool = False) -> None:
        if keep:
            first, *rest = s.split("\n")
            self._add(first)
            for x in rest:
                self.end(blank=True)
                self._add(x)
            return
        flat = _SPACE.sub(" ", s)
        if flat[:1] == " ":
            self.space, flat = True, flat[1:]
        if not flat:
            return
        tail = flat[-1] == " "
        self._add((" " if self.space and self.now else "") + (flat[:-1] if tail else flat))
        self.space = tail

    def _add(self, s: str) -> None:
        if s and not self.now and self.gap:
            if self.done:
                self.done.append("")
            self.gap = False
        self.now += s

    def end(self, gap: bool = False, blank: bool = False) -> None:
        if self.now or blank:
            self.done.append(self.now.rstrip())
        self.now, self.space = "", False
        self.gap |= gap

    def put(self, lines: list[str], gap: bool) -> None:
        self.end(gap=gap)
        if lines:
            if self.gap and self.done:
                self.done.append("")
            self.gap = False
            self.done += lines
        self.gap |= gap


def _rows(node: Node) -> Iterator[tuple[Node, Node]]:
    """Rows with the table or group of rows that they stand in."""
    for k in node.kids:
        if isinstance(k, Node) and visible(k):
            if k.tag == "tr":
                yield node, k
            elif k.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(k)


def _span(cell: Node, name: str, most: int) -> int:
    """A span as browsers read it: at least 1, at most their limit; a rowspan of 0 reaches to the end of the group."""
    text = cell.attrs.get(name, "").strip()
    n = min(int(text[:9]), most) if text.isascii() and text.isdigit() else 1
    return n or (most if name == "rowspan" else 1)


def _table(node: Node) -> list[str]:
    grid, out = [], []
    group, taken = None, {}  # how many more rows of the group a cell above takes, by column
    for part, row in _rows(node):
        if part is not group:
            group, taken = part, {}
        cells, after = [], {}
        for k in row.kids:
            if isinstance(k, Node) and k.tag in ("td", "th") and visible(k):
                while len(cells) in taken:
                    cells.append([])
                down, wide = _span(k, "rowspan", 65_534), _span(k, "colspan", 1000)
                if down > 1:
                    after |= dict.fromkeys(range(len(cells), len(cells) + wide), down - 1)
                cells.append(lines_of(k))
                cells += [[]] * (wide - 1)
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | after
        grid.append(cells)
    widths = [max((width_of(x) for cells in grid if i < len(cells) for x in cells[i]), default=0) for i in range(max(map(len, grid), default=0))]
    for cells in grid:
        for i in range(max(map(len, cells), default=0)):
            shown = [c[i] if i < len(c) else "" for c in cells]
            out.append(" | ".join(x + " " * (w - width_of(x)) for x, w in zip(shown, widths, strict=False)).rstrip())
    # what stands in a table outside its cells is visible too: it goes before, as browsers do
    loose = _Lines()
    _outside(node, loose)
    loose.end()
    return loose.done + out


def _outside(node: Node, loose: _Lines) -> None:
    """What a table, a group of rows or a row holds besides rows and cells."""
    for k in node.kids:
        if isinstance(k, str):
            if k.strip():
                loose.text(k)
        elif k.tag in ("tr", "thead", "tbody", "tfoot") and node.tag != "tr":
            if visible(k):
                loose.end()
                _outside(k, loose)
                loose.end()
        elif not (node.tag == "tr" and k.tag in ("td", "th")):
            _render(k, loose)


def _render(node: Node, out: _Lines, keep: bool = False) -> None:
    if not visible(node):
        return
    tag, attrs = node.tag, node.attrs
    if tag == "br":
        out.end(blank=True)
    elif tag == "hr":
        out.put(["---"], True)
    elif tag == "img":
        out.text(attrs.get("alt", ""))
    elif tag == "input":
        out.text(attrs.get("value", "") if attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "") else "")
    elif tag == "table":
        out.put(_table(node), True)
    elif tag in ("ul", "ol", "menu", "dir"):
        back = tag == "ol" and "reversed" in attrs
        lines, number = [], _number(attrs.get("start", ""))
        if number is None:
            number = sum(isinstance(k, Node) and k.tag == "li" and visible(k) for k in node.kids) if back else 1
        for k in node.kids:
            if isinstance(k, Node) and k.tag == "li" and visible(k):
                own = _number(k.attrs.get("value", "")) if tag == "ol" else None
                number = number if own is None else own
                mark, number = (f"{number}. ", number + (-1 if back else 1)) if tag == "ol" else ("- ", number)
                item = lines_of(k)
                lines += [(mark if i == 0 else " " * len(mark)) + x if x else x for i, x in enumerate(item)]
            else:
                loose = _Lines()
                loose.text(k) if isinstance(k, str) else _render(k, loose)
                loose.end()
                lines += ["  " + x for x in loose.done]
        out.put(lines, True)
    else:
        block, gap = tag in BLOCK, tag in SPACED
        if block:
            out.end(gap=gap)
        if tag in ("td", "th"):
            out.text(" ")
        for k in node.kids:
            out.text(k, keep or tag == "pre") if isinstance(k, str) else _render(k, out, keep or tag == "pre")
        if block:
            out.end(gap=gap)


def lines_of(node: Node) -> list[str]:
    out = _Lines()
    for k in node.kids:
        out.text(k) if isinstance(k, str) else _render(k, out)
    out.end()
    return out.done


def render(page: str | None) -> str:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * DEEPEST))  # a few calls for each level
    root = build(page) if page else Node("#root", {})
    if page and "visibility" in page.lower():
        _unhide(root)
    lines = lines_of(root)
    return "\n".join(lines).strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_lines) for each row of pages (page_id, html, ...).

    A null or empty page has an empty text and no lines. Broken markup never fails: unknown and unclosed tags are read as
    browsers read them. Pages are read whole; elements nested deeper than 512 become siblings, but what is hidden stays so. Repeated rows and null ids
    are kept as they are, other columns are not read, and an empty table gives an empty table.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [render(p) for p in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "text": text, "n_lines": [t.count("\n") + 1 if t else 0 for t in text]})

    t = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("html").cast("string").alias("html")).mapInPandas(run, f"page_id {t}, text string, n_lines long")
