"""HTML extraction with the layout kept (operator 6).

A tree builder reads the markup with implied end tags (paragraphs, list items, table cells, options, heads)
and void elements; visibility rules drop what a browser does not show (scripts, styles, heads, titles,
templates, ``noscript``, ``datalist``, what stands inside ``iframe``, ``audio``, ``video`` and ``canvas`` for
old browsers, definitions and descriptions of drawings, annotations of formulas, ``hidden`` and
``display:none`` elements, comments; texts under ``visibility:hidden`` up to an element that is visible
again). All other text is rendered: blocks begin on new
lines, with an empty line around paragraphs and headings, list items carry their bullet or number with their
depth, ``br`` breaks lines, ``pre`` keeps its blanks, and the cells of a table are laid into a grid, padded so
that its columns stand below each other; a cell over several columns or rows keeps their places. What stands in a table, row group or row outside the cells comes before the table, as
in browsers; cells inside a form or the like there belong to the row. Options, text areas and texts of drawings
have lines of their own. Navigation and the like is visible and stays.

Defined cases: a null page gives a null text, a page without visible text an empty one; broken markup never
fails: stray end tags are dropped and open elements end with their parent; text of any length is read
whole; elements nested deeper than ``DEPTH`` follow each other without nesting, each on its own lines where
one is a block, but what is hidden stays hidden; spans of cells that are no whole numbers count as 1; repeated rows give repeated results; other columns do
not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_arrow

DEPTH = 200
# fixed values: elements of HTML by their part in the layout
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style head title template noscript iframe datalist audio video canvas".split())
#: Hidden inside these elements only.
HIDDEN_IN = {"svg": set("defs desc metadata symbol clippath mask pattern marker".split()), "math": {"annotation", "annotation-xml"}}
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCK = SPACED | set("address article aside body dd details dialog div dt fieldset figcaption footer form header html "
                     "legend li main nav section summary tr caption thead tbody tfoot td th center".split())
#: Begin on a new line, but do not end a paragraph.
OWN_LINE = set("select option optgroup textarea text foreignobject mtr".split())
ROW_PARTS = {"tr", "thead", "tbody", "tfoot", "td", "th"}
#: A start tag ends these open elements, up to the nearest of the bounds.
IMPLIED = {
    **dict.fromkeys(BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "li", "dd", "dt"}, ({"p"}, {"td", "th", "li", "div", "button"})),
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"})),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, {"html"}),
}
_RAW = {"script", "style"}
#: Widest spans of a cell, in columns and rows.
SPANS = {"colspan": 1000, "rowspan": 65534}
#: Between the columns of a table.
GAP = "  "
_BLANKS = re.compile(r"[ \t\n\r\f]+")


def _style(text: str) -> dict[str, str]:
    """Declarations of a style attribute; the last one of a name counts."""
    pairs = (part.split(":", 1) for part in text.lower().split(";") if ":" in part)
    return {name.strip(): value.replace("!important", "").strip() for name, value in pairs}


def _span(value: str | None, name: str) -> int:
    digits = re.match(r"\s*([0-9]{1,9})", value or "")
    return min(int(digits[1]), SPANS[name]) if digits else 1


class Node:
    __slots__ = ("tag", "hidden", "items", "start", "parts", "unseen", "across", "down")

    def __init__(self, tag: str, hidden: bool = False, start: int = 1, unseen: bool = False):
        self.tag, self.hidden, self.items, self.start = tag, hidden, [], start
        self.unseen = unseen  # takes its place, but its own texts are not shown
        self.across = self.down = 1  # columns and rows of a cell; down 0: to the end of the row group
        self.parts = False  # whether rows or cells of the table around it lie inside


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.deep: list[Node] = []  # open elements below DEPTH; their nodes lie side by side
        self.deep_tags = Counter()

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        ends, bounds = IMPLIED.get(tag, ((), ()))
        while self.deep and self.deep[-1].tag in ends:
            self.close_deep()
        if ends and not self.deep:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in bounds:
                    break
                if self.open[k].tag in ends:
                    del self.open[k:]
                    # a row ends its cells, a row group its rows
                    if tag not in ("tr", "thead", "tbody", "tfoot"):
                        break
        style = _style(attrs.get("style") or "")
        above = self.deep[-1] if self.deep else self.open[-1]
        hidden = (tag in HIDDEN or "hidden" in attrs or style.get("display") == "none" or bool(self.deep) and above.hidden
                  or any(tag in tags and self.inside(of) for of, tags in HIDDEN_IN.items()))
        shown = style.get("visibility")
        unseen = shown in ("hidden", "collapse") or (above.unseen and shown not in ("visible", "initial"))
        first = attrs.get("start") or ""
        node = Node(tag, hidden, int(first) if re.fullmatch(r"-?[0-9]{1,9}", first) else 1, unseen)
        if tag in ("td", "th"):
            node.across, node.down = max(1, _span(attrs.get("colspan"), "colspan")), _span(attrs.get("rowspan"), "rowspan")
        self.open[-1].items.append(node)
        if tag in ROW_PARTS:
            for above in reversed(self.open):
                if above.tag == "table" or above.parts:
                    break
                above.parts = True
        if tag in VOID:
            if self.deep:
                self.go_on()
        elif len(self.open) < DEPTH:
            self.open.append(node)
        else:
            self.deep.append(node)
            self.deep_tags[tag] += 1

    def close_deep(self):
        self.deep_tags[self.deep.pop().tag] -= 1

    def go_on(self):
        """What follows in the innermost open element below DEPTH stands after its last child."""
        if self.deep:
            of = self.deep[-1]
            rest = Node("div" if of.tag in BLOCK else "span", of.hidden, unseen=of.unseen)
            self.open[-1].items.append(rest)
            of.items = rest.items

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # only drawings and formulas have elements that end at once
        if self.deep and tag not in VOID and self.deep[-1].tag == tag and not self.deep[-1].items and any(map(self.inside, HIDDEN_IN)):
            self.close_deep()
            self.go_on()
        elif not self.deep and tag not in VOID and self.open[-1] is not self.root and not self.open[-1].items and self.open[-1].tag == tag and any(map(self.inside, HIDDEN_IN)):
            self.open.pop()

    def inside(self, tag: str) -> bool:
        return self.deep_tags[tag] > 0 or any(node.tag == tag for node in self.open)

    def handle_endtag(self, tag):
        if self.deep_tags[tag]:
            while self.deep[-1].tag != tag:
                self.close_deep()
            self.close_deep()
            self.go_on()
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                self.deep.clear()
                self.deep_tags.clear()
                return
            if self.open[k].tag == "table" and tag in IMPLIED and tag != "table":
                return

    def handle_data(self, data):
        node = self.deep[-1] if self.deep else self.open[-1]
        if not node.unseen:
            node.items.append(data)


class _Lines:
    """Output lines: text runs are joined, blocks break, spaced blocks keep one empty line."""

    def __init__(self):
        self.lines, self.current, self.gap = [], "", 0

    def text(self, data: str, kept: bool):
        if kept:
            first, *rest = data.split("\n")
            self._add(first)
            for line in rest:
                self.end()
                self._add(line)
            return
        data = _BLANKS.sub(" ", data)
        if not self.current or self.current.endswith(" "):
            data = data.lstrip(" ")
        self._add(data)

    def _add(self, data: str):
        if data and self.gap and not self.current:
            if self.lines:
                self.lines += [""] * (self.gap - 1)
            self.gap = 0
        self.current += data

    def end(self):
        self.lines.append(self.current.rstrip(" "))
        self.current = ""

    def block(self, spaced: bool):
        if self.current.strip():
            self.end()
        self.current = ""
        self.gap = max(self.gap, 2 if spaced else 1)

    def done(self) -> str:
        self.block(False)
        return "\n".join(self.lines).strip("\n")


def _inner(node: Node) -> str:
    lines = _Lines()
    _children(node, lines, 0, False)
    return lines.done()


def _lay_out(node: Node, rows: list[list[Node]], groups: set[int], stray: list, row: list[Node] | None, shown: bool = True):
    """Cells by row, the rows at which row groups begin, what stands outside of cells; None in ``stray`` where a row begins."""
    for item in node.items:
        if isinstance(item, str):
            if shown and item.strip():
                stray.append(item)
        elif item.tag in ROW_PARTS:
            if item.hidden:
                continue
            if item.tag in ("td", "th"):
                if row is None:
                    rows.append(row := [])
                row.append(item)
            else:
                row = None
                stray.append(None)
                if item.tag == "tr":
                    rows.append([])
                else:
                    groups.add(len(rows))
                _lay_out(item, rows, groups, stray, rows[-1] if item.tag == "tr" else None, shown)
                if item.tag != "tr":
                    groups.add(len(rows))
        elif item.parts and item.tag != "table":
            _lay_out(item, rows, groups, stray, row, shown and not item.hidden)
        elif shown:
            stray.append(item)


def _places(rows: list[list[Node]], groups: set[int]) -> list[list[tuple[int, int]]]:
    """First column and column after the last of every cell, beside the cells that come down from rows above."""
    held: list[tuple[int, int, int]] = []  # first column, column after the last, first row that is free again
    places = []
    for number, row in enumerate(rows):
        if number in groups:
            held = []
        held = [h for h in held if h[2] > number]
        column, taken, mine = 0, iter(held), []
        over = next(taken, None)
        for cell in row:
            while over and over[0] <= column:
                column = max(column, over[1])
                over = next(taken, None)
            mine.append((column, column + cell.across))
            column += cell.across
        places.append(mine)
        down = [(*place, number + cell.down if cell.down else len(rows)) for place, cell in zip(mine, row) if cell.down != 1]
        if down:
            held = sorted(held + down)
    return places


def _table(node: Node, out: _Lines, depth: int):
    found: list[list[Node]] = []
    groups: set[int] = set()
    stray: list = []
    _lay_out(node, found, groups, stray, None)
    for item in stray:  # captions and stray content come before the rows
        if item is None:
            out.block(False)
        elif isinstance(item, str):
            out.text(item, False)
        else:
            _render(item, out, depth, False)
    out.block(False)
    places = _places(found, groups)
    # columns in which no cell begins have no width
    begins = sorted({first for row in places for first, _ in row})
    rows = [[(bisect_left(begins, first), bisect_left(begins, end), _inner(cell).split("\n")) for (first, end), cell in zip(place, row)]
            for place, row in zip(places, found)]
    width = [0] * len(begins)
    wide = []
    for row in rows:
        for first, end, lines in row:
            size = max(map(len, lines))
            if end - first == 1:
                width[first] = max(width[first], size)
            else:
                wide.append((end - first, first, end, size))
    for _, first, end, size in sorted(wide):  # the last column of a wide cell takes what its columns do not hold
        width[end - 1] += max(0, size - sum(width[first:end]) - len(GAP) * (end - first - 1))
    offset = list(accumulate((w + len(GAP) for w in width), initial=0))
    for row in rows:
        for line in range(max((len(lines) for _, _, lines in row), default=0)):
            text = ""
            for first, _, lines in row:
                if line < len(lines) and lines[line]:
                    # cells that lie over each other stand side by side
                    text = text.ljust(max(offset[first], len(text) + len(GAP) if text else 0)) + lines[line]
            if text := text.rstrip():
                out.text(text, True)
                out.block(False)


def _render(node: Node, out: _Lines, depth: int, kept: bool, marker: str = ""):
    if node.hidden:
        return
    tag = node.tag
    if tag == "br":
        out.end()
    elif tag == "img":
        return
    elif tag == "table":
        out.block(True)
        _table(node, out, depth)
        out.block(True)
    elif tag == "svg":
        _drawing(node, out, depth)
    else:
        block = tag in BLOCK or tag in OWN_LINE
        spaced = tag in SPACED and not (tag in ("ul", "ol") and depth)
        if block:
            out.block(spaced)
        if marker:
            before = len(out.lines), out.current
            out.text("  " * max(0, depth - 1) + marker, True)
            _children(node, out, depth, kept)
            if len(out.lines) == before[0] and not out.current.strip(" " + marker):
                out.current = ""
        else:
            _children(node, out, depth + (tag in ("ul", "ol")), kept or tag in ("pre", "textarea"))
        if block:
            out.block(spaced)


def _drawing(node: Node, out: _Lines, depth: int):
    """The texts of a drawing; characters outside of them are not shown."""
    for item in node.items:
        if isinstance(item, Node) and not item.hidden:
            if item.tag in ("text", "foreignobject"):
                _render(item, out, depth, False)
            else:
                _drawing(item, out, depth)


def _children(node: Node, out: _Lines, depth: int, kept: bool):
    number = node.start
    for k, item in enumerate(node.items):
        if k and node.tag in ("mtr", "mfrac"):
            out.text(" ", kept)
        if isinstance(item, str):
            out.text(item, kept)
        elif item.tag == "li" and not item.hidden:
            marker = f"{number}. " if node.tag == "ol" else "- "
            _render(item, out, max(1, depth), kept, "" if item.unseen else marker)
            number += 1
        else:
            _render(item, out, depth, kept)


def render(html: str) -> str:
    """The visible text of a page."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return _inner(builder.root)


def extract_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """``page_id``, the carried columns and ``text`` of every page."""
    carry = tuple(c for c in carry if c in pages.columns)
    pages = pages.select(F.col(id_col).alias("page_id"), *carry, F.col(html_col).alias("__html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields[:-1])

    def work(batches):
        for batch in batches:
            texts = [None if h is None else render(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             names=[*batch.schema.names[:-1], "text"])
    return map_arrow(pages, work, f"{kinds}, text string")
