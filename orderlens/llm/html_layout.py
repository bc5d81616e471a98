"""HTML to text as laid out: a small tree builder and a block renderer.

The builder makes a tree from tags with implied ends and starts (a new ``<p>``, list
item, table row or cell ends the open one; a cell outside a row starts one; a block ends
an open paragraph). The renderer emits all visible text:

- nothing of ``head``, scripts, styles, templates, ``noscript``, ``datalist``, the fallback
  in ``object``, ``audio``, ``video``, ``canvas`` and frames, ``hidden`` elements,
  ``display:none``, ``visibility:hidden`` (a descendant may be visible again), closed
  ``details`` but for their summary;
- all choices of a ``select``, each on a line; of ``svg`` what it draws as text (``text``
  and ``foreignObject``, not ``defs``, ``title`` and the like), of ``math`` all but
  annotations. Tags in them follow the rules of foreign content: a trailing slash ends
  the element, a tag that only html has ends the drawing or formula;
- blocks on lines of their own, paragraphs, headings, lists and tables apart by a blank
  line; white space collapsed except in ``pre`` and ``textarea``; ``br`` breaks a line;
- list items with ``- `` or their number, nested lists indented;
- table cells in columns padded to equal width; ``colspan`` widens its columns, ``rowspan``
  holds its columns in the rows below, to the end of its section; a hidden cell keeps its
  column.

One page is parsed in one call; pages are spread by Spark, texts stay in Arrow.
Unclosed or stray tags, broken entities and nesting of any depth give a result: the tree
is as deep as the page, and laid out without recursion. Only layout has a limit: in
``MAX_DEPTH`` lists, quotes and tables within each other, deeper ones are neither indented
nor aligned; their text and visibility stay.

Edge cases: null html gives a null text, empty html an empty one; equal pages get equal
texts; an empty table gives no rows; extra columns stay, those named like a result are
replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Collection, Generator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import quoted, ship_package, with_results

MAX_DEPTH = 200

# Element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INVISIBLE = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas datalist area".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul tr caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu dir".split())
#: What a start tag ends, looked for up to the nearest of the elements after it.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "option": (("option",), ("select",)),
    "optgroup": (("optgroup",), ("select",)),
}
#: Inside ``svg`` and ``math``: what is not drawn, what holds html again, what stands apart
#: from its neighbours, and tags that end the drawing or formula.
NOT_DRAWN = frozenset(
    "defs title desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter script style "
    "annotation annotation-xml mphantom".split()
)
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
APART = frozenset("text foreignobject mtr mtd".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
IN_HEAD = frozenset("base link meta title style script noscript template".split())

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|-?>|.*\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text) if text else ():
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _ends_itself(text: str) -> bool:
    """Whether attributes end in a slash that is no part of an unquoted value."""
    if not text.endswith("/"):
        return False
    last = None
    for last in _ATTRIBUTE.finditer(text):
        pass
    return last is None or not last[4] or last.end() < len(text)


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("html", {})
    stack = [root]
    places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
    any_foreign = False

    def open_(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def cut(place: int) -> None:
        while len(stack) > place:
            places[stack.pop().tag].pop()

    def last(tags: Collection[str]) -> int:
        """Place of the innermost open element of these, 0 for none."""
        found = 0
        for tag in tags:
            if places.get(tag):
                found = max(found, places[tag][-1])
        return found

    def close(tags: tuple[str, ...], limits: tuple[str, ...]) -> None:
        place = last(tags)
        if place and place >= last(limits):
            cut(place)

    def foreign() -> bool:
        """Whether the innermost open element is of ``svg`` or ``math``."""
        return any_foreign and last(("svg", "math")) > last(HTML_AGAIN)

    def undrawn() -> bool:
        """Whether text here is part of a drawing but of no text in it."""
        return any_foreign and last(("svg",)) > last(("text", "foreignobject", "math"))

    def break_out() -> None:
        while foreign():
            cut(last(("svg", "math")))

    def start_foreign(tag: str, attrs: dict[str, str], ended: bool) -> None:
        if stack[-1].tag == "head":
            cut(len(stack) - 1)
        if tag in NOT_DRAWN:
            attrs["hidden"] = ""
        elif tag in APART or stack[-1].tag == "mfrac":
            attrs[""] = "apart"
        given = [f"{k}:{attrs[k]}" for k in ("display", "visibility") if k in attrs]
        if given:
            attrs["style"] = ";".join([*given, attrs.get("style", "")])
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if not ended:
            open_(node)

    def start(tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            root.attrs.update(attrs)
            return
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            cut(len(stack) - 1)
        if tag in BLOCKS:
            close(("p",), ("table", "td", "th", "caption", "button", "object"))
        if tag[0] == "h" and tag[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
            cut(len(stack) - 1)
        if tag == "optgroup":
            close(("option",), ("optgroup", "select"))
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ("thead", "tbody", "tfoot", "tr"):
            close(("tr",), ("table",))
        if tag in ("td", "th") and last(("tr",)) <= last(("table",)):
            start("tr", {})
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag not in VOID:
            open_(node)

    def end(tag: str) -> None:
        limit = 0 if tag in ("table", "body", "html") else last(("td", "th", "table", "caption"))
        place = last((tag,))
        if place and place >= limit:
            cut(place)
        elif limit:
            return
        elif tag == "p":
            start("p", {})
            cut(len(stack) - 1)
        elif tag == "br":
            stack[-1].children.append(Node("br", {}))

    place = 0
    while True:
        m = _TOKEN.search(html, place)
        text = html[place : m.start() if m else len(html)]
        if text:
            if stack[-1].tag == "head" and text.strip():
                cut(len(stack) - 1)
            if not undrawn():
                stack[-1].children.append(unescape(text) if "&" in text else text)
        if not m:
            return root
        place = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in ("p", "br"):
                break_out()
            end(tag)
        elif m[2] or m[4]:
            tag, given = (m[2] or m[4]).lower(), m[3] or m[5] or ""
            attrs = _attributes(given)
            inside = foreign()
            if inside and (tag in BREAKOUT or (tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")))):
                break_out()
                inside = False
            if inside or tag in ("svg", "math"):
                any_foreign = True
                start_foreign(tag, attrs, _ends_itself(given))
                continue
            start(tag, attrs)
            if tag in RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, place)
                body = html[place : closing.start() if closing else len(html)]
                place = closing.start() if closing else len(html)
                node = stack[-1]
                if node.tag == tag and body:
                    node.children.append(unescape(body) if tag in ("textarea", "title") else body)
        elif m[0].startswith("<![CDATA[") and foreign():
            close_at = html.find("]]>", m.start())
            body = html[m.start() + 9 : close_at if close_at >= 0 else len(html)]
            place = close_at + 3 if close_at >= 0 else len(html)
            if not undrawn():
                stack[-1].children.append(body)


def _hidden(node: Node) -> bool:
    if node.tag in INVISIBLE or "hidden" in node.attrs:
        return True
    if node.tag == "dialog" and "open" not in node.attrs:
        return True
    style = node.attrs.get("style")
    return bool(style) and any(k.lower() == "display" and v.lower() == "none" for k, v in _STYLE.findall(style))


def _visible(node: Node, shown: bool) -> bool:
    """Visibility of an element within one of visibility ``shown``."""
    style = node.attrs.get("style")
    for k, v in _STYLE.findall(style) if style else ():
        if k.lower() == "visibility" and v.lower() != "inherit":
            shown = v.lower() not in ("hidden", "collapse")
    return shown


class Layout:
    """Lines of one block context."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = 0  # blank lines owed before the next text

    def text(self, s: str) -> None:
        self.run.append(s)

    def flush(self) -> None:
        joined = "".join(self.run)
        self.run = []
        for part in joined.split("\x00"):  # kept breaks
            line = _SPACE.sub(" ", part).strip(" ")
            if line:
                self.put(line.replace("\x01", " ").replace("\x02", ""))
            elif part != joined and self.lines and not self.gap and joined.strip(" \t\n\f\r\x00"):
                self.lines.append("")

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        self.lines.append(line.rstrip())

    def space(self) -> None:
        self.flush()
        self.gap = 1

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        for i, line in enumerate(lines):
            self.put((first if i == 0 else rest) + line if line else line)


#: Steps of the layout yield the steps that they wait for; ``_run`` calls them.
Step = Generator["Step", object, object]


def _run(step: Step) -> object:
    stack, value = [step], None
    while stack:
        try:
            inner = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(inner)
            value = None
    return value


def _lay(node: Node, out: Layout, shown: bool, pre: bool, depth: int) -> Step:
    """Lay the children of a node into ``out``, which is in ``depth`` others."""
    number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
    only_summary = node.tag == "details" and "open" not in node.attrs
    flat = depth >= MAX_DEPTH
    for child in node.children:
        if isinstance(child, str):
            if shown and not only_summary:
                out.text(child.replace("\r\n", "\n").replace("\n", "\x00").replace(" ", "\x01").replace("\t", "\x01\x01\x01\x01") if pre else child.replace("\x00", ""))
            continue
        if _hidden(child) or (only_summary and child.tag != "summary"):
            continue
        visible = _visible(child, shown)
        tag = child.tag
        if tag == "br":
            out.text("\x00")
        elif tag == "hr":
            out.space()
        elif flat and tag in ("table", "tr", "li", "dd", "blockquote"):
            out.flush()
            yield _lay(child, out, visible, pre, depth)
            out.flush()
        elif tag == "table":
            out.space()
            out.block((yield _table(child, visible, depth + 1)))
            out.space()
        elif tag == "li":
            out.flush()
            mark = "- "
            if node.tag == "ol":
                value = child.attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                mark, number = f"{number}. ", number + 1
            inner = Layout()
            yield _lay(child, inner, visible, pre, depth + 1)
            inner.flush()
            while inner.lines and not inner.lines[0]:
                inner.lines.pop(0)
            out.block(inner.lines, mark, " " * len(mark))
        elif tag in ("dd", "blockquote"):
            out.space() if tag in SPACED else out.flush()
            inner = Layout()
            yield _lay(child, inner, visible, pre, depth + 1)
            inner.flush()
            out.block(inner.lines, "  ", "  ")
            out.space() if tag in SPACED else None
        elif tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu", "dir") and node.tag == "li"
            apart = tag in SPACED and not nested
            out.space() if apart else out.flush()
            yield _lay(child, out, visible, pre or tag == "pre", depth)
            out.space() if apart else out.flush()
        elif tag in ("option", "optgroup"):
            out.flush()
            label = child.attrs.get("label", "")
            if label and visible:
                out.text(label.replace("\x00", ""))
                out.flush()
            if tag == "optgroup" or not label:
                yield _lay(child, out, visible, pre, depth)
            out.flush()
        else:
            apart = "" in child.attrs
            if apart:
                out.text(" ")
            if child.children:
                yield _lay(child, out, visible, pre or tag == "textarea", depth)
            if tag in ("td", "th") or apart:
                out.text(" ")


def _holder(tag: str, child: Node | str) -> Node:
    node = Node(tag, {})
    node.children.append(child)
    return node


def _rows(table: Node, shown: bool, section: int = 0) -> list[tuple[Node, bool, int]]:
    """Rows of a table in document order, each with the visibility around it and its
    section: caption apart, sections opened."""
    found: list[tuple[Node, bool, int]] = []
    for i, child in enumerate(table.children, 1):
        if isinstance(child, str):
            if child.strip():
                found.append((_holder("div", child), shown, section))
        elif not _hidden(child):
            if child.tag in ("thead", "tbody", "tfoot") and not section:
                found += _rows(child, _visible(child, shown), i)
            else:
                found.append((child, shown, section))
    return found


def _span(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "").strip()
    return min(int(value), most) if re.fullmatch(r"\d{1,9}", value) else 1


def _table(table: Node, shown: bool, depth: int) -> Step:
    """Lines of a table. A cell of the grid is its first column, the column after it and
    its lines."""
    grid: list[list[tuple[int, int, list[str]]] | list[str]] = []
    held: list[tuple[int, int, float]] = []  # columns from, to, up to a row: of cells in rows above
    before = 0
    for number, (row, around, section) in enumerate(_rows(table, shown)):
        if row.tag != "tr":
            inner = Layout()
            yield _lay(_holder("div", row), inner, around, False, depth)
            inner.flush()
            grid.append(inner.lines)
            continue
        if section != before:
            held, before = [], section
        visible = _visible(row, around)
        held = [h for h in held if h[2] >= number]
        cells, new, at, taken = [], [], 0, 0
        for cell in row.children:
            if isinstance(cell, str):
                if not cell.strip():
                    continue
                cell = _holder("td", cell)
            elif _hidden(cell):
                continue
            while taken < len(held) and held[taken][0] <= at:
                at = max(at, held[taken][1])
                taken += 1
            inner = Layout()
            loose = cell.tag not in ("td", "th")
            yield _lay(_holder("td", cell) if loose else cell, inner, visible if loose else _visible(cell, visible), False, depth)
            inner.flush()
            after = at + max(_span(cell, "colspan", 1000), 1)
            rows = _span(cell, "rowspan", 65534)
            if rows != 1:
                new.append((at, after, number + rows - 1 if rows else float("inf")))
            cells.append((at, after, inner.lines))
            at = after
        held = sorted(held + new)
        if any(lines for *_, lines in cells):
            grid.append(cells)
    # columns in which a cell begins, and where they stand: after all cells that end before
    ruled = [row for row in grid if row and isinstance(row[0], tuple)]
    columns = sorted({at for row in ruled for at, *_ in row})
    ends: list[list[tuple[int, int]]] = [[] for _ in range(len(columns) + 1)]
    for row in ruled:
        for at, after, lines in row:
            ends[bisect_left(columns, after)].append((at, max(map(len, lines), default=0)))
    place: dict[int, int] = {}
    for i, column in enumerate(columns):
        least = place[columns[i - 1]] + 2 if i else 0
        place[column] = max([least, *(place[at] + wide + 2 for at, wide in ends[i])])
    out: list[str] = []
    for row in grid:
        if not row or not isinstance(row[0], tuple):
            out += row
            continue
        for i in range(max(len(lines) for *_, lines in row)):
            line = ""
            for at, _, lines in row:
                if i < len(lines):
                    line = line.ljust(place[at]) + lines[i]
            out.append(line.rstrip())
    return out


def render(html: str | None) -> str | None:
    """The visible text of a page."""
    if html is None:
        return None
    out = Layout()
    _run(_lay(parse(html), out, True, False, 0))
    out.flush()
    return "\n".join(out.lines).strip("\n")


@F.arrow_udf(T.StringType())
def _rendered(pages: pa.Array) -> pa.Array:
    return pa.array([render(x.as_py()) for x in pages], pa.string())


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the visible text of their html."""
    ship_package(pages.sparkSession)
    return with_results(pages, {out_col: _rendered(quoted(html_col).cast("string"))})
