"""Layout-aware rendering of HTML to plain text.

A tree builder with implied tags makes a tree of any input; a renderer walks what is visible.
Blocks stand on lines of their own, paragraphs, headings, lists and tables between blank lines,
list items after a mark and indented by depth, table cells in aligned columns. Runs of ASCII
white space count as one space, except in preformatted text; other spaces are text.

What hides text is the element's kind, its hidden attribute and its own style: display:none hides
all inside, visibility:hidden what doesn't set it visible again. Style sheets are not considered.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Of elements nested deeper than this, visible text and line breaks are kept at this depth.
DEEPEST = 200
#: Cells wider than this don't widen their column, so one long cell doesn't pad all rows.
WIDEST = 120
#: A table with fewer than one of so many places filled is written without padding.
SPARSEST = 64
#: Cells that reach into rows below and are heeded at once; more only shift columns.
MOST_SPANS = 1000

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link iframe noembed noframes object video audio canvas datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul xmp".split())
ENDS_P = BLOCK - frozenset("body html option optgroup tbody td tfoot th thead tr".split())
CELLS = frozenset(("td", "th"))
#: Elements of drawings that show nothing by themselves, and start tags that end a drawing.
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())
ENDS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small "
    "span strong strike sub sup table tt u ul var".split()
)
#: What a start tag closes first, and the elements that it does not look past.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir", "table", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), frozenset(("table", "thead", "tbody", "tfoot"))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup")), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup")), frozenset(("table",))),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE_PARTS = frozenset("table tr tbody thead tfoot td th".split())
STOPS_END = frozenset(("table", "td", "th", "caption", "button"))

# A quote opens a quoted run only as an attribute's value, right after the "=" of a name.
_token = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)?+)?+)*+)>", re.S
)
_attr = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|((?![\"'])[^\s>]++))?+)?+")
_display = re.compile(r"(?:^|[;\s])display\s*:\s*([a-z-]+)", re.I)
_visibility = re.compile(r"(?:^|[;\s])visibility\s*:\s*(visible|hidden|collapse)", re.I)
_blanks = re.compile(r"[ \t\n\f\r]+")
_zeros = re.compile(r"(&#[xX]?)0+(?=[0-9a-fA-F])")
_beyond = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_number = re.compile(r"[ \t\n\f\r]*\+?0*([0-9]*)")


def unescape(s: str) -> str:
    """Character references replaced; numbers of any length that name no character are U+FFFD."""
    if "&#" in s:
        s = _beyond.sub("\ufffd", _zeros.sub(r"\1", s))
    return html.unescape(s) if "&" in s else s


def number(s: str | None, default: int, most: int) -> int:
    """The digits that an attribute's value begins with, at most `most`."""
    digits = _number.match(s)[1] if s else ""
    if not digits:
        return 0 if s and "0" in s.strip()[:1] else default
    return min(int(digits), most) if len(digits) < 10 else most


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attr(self, name: str) -> str | None:
        """The first value of an attribute; empty if it has none, None if it isn't there."""
        for m in _attr.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


class Builder:
    """A tree from any input: implied start and end tags, void and raw elements, stray end tags ignored.

    Open elements are found by name in lists of their places, so that no nesting makes it slow.
    """

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}
        #: From which place on, beyond DEEPEST, open elements are hidden.
        self.hidden: int | None = None

    def build(self, source: str) -> Node:
        at, n = 0, len(source)
        last = source.rfind(">")  # nothing after it is a tag
        while at < n:
            m = _token.search(source, at) if at <= last else None
            if m is None:
                self.text(re.split("<[!?]", source[at:], maxsplit=1)[0])  # a comment open at the end goes on to it
                break
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"]:
                self.end(tag)
                continue
            self.start(tag, m["attrs"])
            if tag in RAW and self.open[-1].tag == tag:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                body = source[at : close.start() if close else n]
                if tag in ("textarea", "title"):
                    body = unescape(body)
                if tag not in UNSEEN:
                    self.add(body)
                self.pop_to(len(self.open) - 1)
                at = close.end() if close else n
        return self.root

    def add(self, x) -> None:
        """A text or an element without content, where the open element is."""
        if self.hidden is None:
            self.open[min(len(self.open) - 1, DEEPEST)].children.append(x)

    def text(self, s: str) -> None:
        self.add(unescape(s))

    def last(self, tags) -> int:
        """The innermost place where one of these is open, 0 if none is."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def drawing(self) -> int:
        """The place of the open drawing whose content this is, 0 if it is none's."""
        at = self.last(("svg",))
        return at if at > self.last(("foreignobject", "desc")) else 0

    def start(self, tag: str, attrs: str) -> None:
        drawing = self.drawing()
        if drawing and tag in ENDS_SVG:
            self.pop_to(drawing)
            drawing = 0
        if tag in ("html", "body"):
            if tag == "body":
                self.end("head")
            if tag == "body" and not self.places.get("body"):
                self.push(Node(tag, attrs))
            return
        if tag in ENDS_P:
            self.close(frozenset(("p",)), STOPS_END)
            if self.open[-1].tag == "head" and tag not in ("title", "noscript"):
                self.end("head")
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        here = self.open[-1].tag
        if tag == "tr" and here == "table":
            self.push(Node("tbody"))
        elif tag in CELLS and here in ("table", "thead", "tbody", "tfoot"):
            if here == "table":
                self.push(Node("tbody"))
            self.push(Node("tr"))
        node = Node(tag, attrs)
        if tag in VOID or (attrs.endswith("/") and (drawing or tag in ("svg", "math", "path"))):
            self.add(node)
        else:
            self.push(node)

    def push(self, node: Node) -> None:
        at = len(self.open)
        if at <= DEEPEST:
            self.open[-1].children.append(node)
        elif self.hidden is None:
            shown = visible(node)
            if shown and node.tag in BLOCK:
                self.add(Node("div"))
            if not shown or dark(node, False):
                self.hidden = at
        self.open.append(node)
        self.places.setdefault(node.tag, []).append(at)

    def pop_to(self, at: int) -> None:
        """Close all open elements from a place on."""
        while len(self.open) > at:
            node = self.open.pop()
            self.places[node.tag].pop()
            if self.hidden == len(self.open):
                self.hidden = None
            elif len(self.open) > DEEPEST and node.tag in BLOCK:
                self.add(Node("div"))

    def close(self, tags: frozenset, stops: frozenset) -> None:
        """Close all open elements from the outermost of these tags on, not past a stop."""
        stop = self.last(stops - tags)
        inside = [own[i] for own in (self.places.get(t) for t in tags) if own and (i := bisect.bisect(own, stop)) < len(own)]
        if inside:
            self.pop_to(min(inside))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.add(Node("br"))
            return
        if tag in ("body", "html"):
            return
        stops = ("table",) if tag in TABLE_PARTS else STOPS_END
        at = self.last((tag,))
        if at and at >= self.last(stops):
            self.pop_to(at)
        elif tag == "p" and not self.last(stops):
            self.add(Node("p"))


def visible(node: Node) -> bool:
    """Whether an element is displayed at all."""
    if node.tag in UNSEEN:
        return False
    low = node.attrs
    if not low or low.isspace():
        return True
    shown = _display.findall(node.attr("style") or "") if "style" in low.lower() else None
    if shown:
        return shown[-1].lower() != "none"
    if node.attr("hidden") is not None:
        return False
    return node.tag != "input" or (node.attr("type") or "").lower() != "hidden"


def dark(node: Node, before: bool) -> bool:
    """Whether an element's texts are invisible, where those around it are so or not."""
    if not node.attrs or "visibility" not in node.attrs.lower():
        return before
    told = _visibility.findall(node.attr("style") or "")
    return told[-1].lower() != "visible" if told else before


class Lines:
    """Lines of text; breaks: 1 ends a line, 2 leaves a blank one."""

    def __init__(self):
        self.done: list[str] = []
        self.run: list[str] = []
        self.first, self.rest = "", ""
        #: Text that comes now is invisible.
        self.dark = False

    def add(self, s: str) -> None:
        if self.dark:
            return
        if not self.run:
            s = s.lstrip(" ")
            if not s:
                return
            self.run.append(self.first)
            self.first = self.rest
        elif s[0] == " " and self.run[-1][-1:] == " ":
            s = s[1:]
        if s:
            self.run.append(s)

    def line(self, s: str) -> None:
        """A whole line as it is."""
        self.end(1)
        self.done.append(self.first + s)
        self.first = self.rest

    def end(self, breaks: int) -> None:
        if self.run:
            self.done.append("".join(self.run).rstrip(" "))
            self.run = []
        if breaks == 2 and self.done and self.done[-1] != "":
            self.done.append("")

    def cut(self) -> None:
        """A line break in the text: an empty line if the line is empty."""
        if self.run:
            self.end(1)
        elif self.done and self.done[-1] != "":
            self.done.append("")

    def text(self) -> str:
        self.end(1)
        return "\n".join(self.done).strip("\n")


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in s)


def _rows(node: Node) -> Iterator[Node]:
    for x in node.children:
        if isinstance(x, Node) and visible(x):
            if x.tag == "tr":
                yield x
            elif x.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(x)


def _table(node: Node, out: Lines, depth: int) -> None:
    """Rows below each other, cells in aligned columns, each with its own lines. Text outside cells comes before.

    A cell goes to the first free column; those it spans, also in rows below, are taken.
    """
    for x in node.children:
        if not isinstance(x, Node) or x.tag not in ("thead", "tbody", "tfoot", "tr"):
            _inside(x, out, depth)
        elif visible(x) and x.tag != "tr":
            for y in x.children:
                if not isinstance(y, Node) or y.tag != "tr":
                    _inside(y, out, depth)
    grid: list[dict[int, list[str]]] = []
    taken: list[tuple[int, int, int]] = []  # columns from, to, and how many rows more
    for row in _rows(node):
        out.end(1)
        line: dict[int, list[str]] = {}
        at, below, open_ = 0, [], iter(taken)
        ahead = next(open_, None)
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in CELLS:
                _inside(cell, out, depth)
            elif visible(cell):
                while ahead and ahead[0] <= at:
                    at = max(at, ahead[1])
                    ahead = next(open_, None)
                inner = Lines()
                inner.dark = dark(row, dark(node, out.dark))
                for x in cell.children:
                    _inside(x, inner, depth, shade=dark(cell, inner.dark))
                if lines := [s for s in inner.text().split("\n") if s]:
                    line[at] = lines
                across, down = (1, 1) if not cell.attrs else (max(1, number(cell.attr("colspan"), 1, 1000)), number(cell.attr("rowspan"), 1, 65534))
                if down != 1:  # 0: to the end of the table
                    below.append((at, at + across, (down or 65535) - 1))
                at += across
        if taken or below:
            taken = sorted([(a, b, n - 1) for a, b, n in taken if n > 1] + below)[:MOST_SPANS]
        if line:
            grid.append(line)
    out.end(2)
    widths: dict[int, int] = {}
    for line in grid:
        for i, lines in line.items():
            widths[i] = max(widths.get(i, 0), max((w for w in map(_width, lines) if w <= WIDEST), default=0))
    columns = sorted(widths)
    if len(columns) * len(grid) > SPARSEST * sum(map(len, grid)):
        for line in grid:
            out.line("  ".join(s for i in sorted(line) for s in line[i]))
        grid = []
    for line in grid:
        for n in range(max(map(len, line.values()))):
            cells = [line[i][n] if i in line and n < len(line[i]) else "" for i in columns]
            out.line("  ".join(s + " " * (widths[i] - _width(s)) for i, s in zip(columns, cells, strict=True)).rstrip(" "))
    out.end(2)


def _inside(x, out: Lines, depth: int = 0, pre: bool = False, shade: bool | None = None) -> None:
    """One text or element; shade: whether it is invisible, if that isn't what it was before."""
    before = out.dark
    if shade is not None:
        out.dark = shade
    if isinstance(x, str):
        _text(x, out, pre)
    elif visible(x):
        out.dark = dark(x, out.dark)
        _element(x, out, depth, pre)
    out.dark = before


def _text(x: str, out: Lines, pre: bool) -> None:
    if not out.dark:
        if pre:
            lines = x.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            for i, s in enumerate(lines):
                if i:
                    out.end(1) if out.run else out.done.append("")
                if s:
                    if not out.run:
                        out.run.append(out.first)
                    out.run.append(s)
            return
        s = _blanks.sub(" ", x)
        if s and (s != " " or out.run):
            out.add(s)


def _element(x: Node, out: Lines, depth: int, pre: bool) -> None:
    tag = x.tag
    if tag == "br":
        out.cut()
    elif tag == "hr":
        out.end(2)
    elif tag == "img":
        if alt := _blanks.sub(" ", x.attr("alt") or "").strip(" "):
            out.add(alt)
    elif tag == "svg":
        _svg(x, out, depth)
    elif tag == "table":
        out.end(2)
        _table(x, out, depth)
    elif tag in BLOCK:
        gap = 2 if tag in SPACED and not (depth and tag in ("ul", "ol", "menu")) else 1
        out.end(gap)
        if tag in ("ul", "ol", "menu", "dir"):
            _list(x, out, depth, tag == "ol")
        elif tag == "details" and x.attr("open") is None:
            for y in x.children:
                if isinstance(y, Node) and y.tag == "summary":
                    _inside(y, out, depth, pre)
        else:
            if tag == "dd":
                before = out.first, out.rest
                out.first = out.rest = out.rest + "  "
            for y in x.children:
                _inside(y, out, depth, pre or tag in ("pre", "xmp"))
            if tag == "dd":
                out.end(1)
                out.first, out.rest = before
        out.end(gap)
    else:
        for y in x.children:
            _inside(y, out, depth, pre)


def _svg(node: Node, out: Lines, depth: int) -> None:
    """Of a drawing, its texts, each on a line of its own."""
    before = out.dark
    for x in node.children:
        if isinstance(x, Node) and x.tag not in UNDRAWN and visible(x):
            out.dark = dark(x, before)
            if x.tag in ("text", "foreignobject"):
                out.end(1)
                for y in x.children:
                    _inside(y, out, depth)
                out.end(1)
            else:
                _svg(x, out, depth)
    out.dark = before


def _list(node: Node, out: Lines, depth: int, numbered: bool) -> None:
    start = node.attr("start") if numbered and node.attrs else None
    n = int(start) if start and re.fullmatch(r"-?[0-9]{1,9}", start) else 1
    for x in node.children:
        if isinstance(x, Node) and x.tag == "li" and visible(x):
            mark = f"{n}. " if numbered else "- "
            n += 1
            first, rest = out.first, out.rest
            out.end(1)
            out.first, out.rest = rest + mark, rest + " " * len(mark)
            shade = dark(x, out.dark)
            for y in x.children:
                _inside(y, out, depth + 1, shade=shade)
            out.end(1)
            out.first, out.rest = first, rest
        else:
            _inside(x, out, depth + 1)


def render(source: str | None) -> str:
    """All visible text of an HTML page; empty for null or empty input."""
    if not source:
        return ""
    out = Lines()
    for x in Builder().build(source.replace("\0", "�")).children:
        _inside(x, out)
    return out.text()


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, size, first = [], 0, 0
        ids = batch.column("page_id")
        for i, x in enumerate(batch.column("html")):
            texts.append(render(x.as_py()))
            size += len(texts[-1])
            if size > 4 << 20 or i == len(ids) - 1:
                lines = [t.count("\n") + 1 if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)).cast(pa.int64()), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], names=["page_id", "text", "n_lines"])
                texts, size, first = [], 0, i + 1


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_lines), one row for each row of pages(page_id, html, ...).

    Null and empty pages give an empty text of 0 lines. Any input gives a result: tags that don't
    close, stray ends, deep nesting and numbers of any length lose no visible text and show no
    hidden one. Other columns are ignored; an empty table gives an empty table.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_render_batches, "page_id long, text string, n_lines long")
