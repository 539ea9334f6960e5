"""Visible text of HTML pages, laid out.

A stack of open elements builds the tree as a browser would, with the tags that authors leave out: blocks end a paragraph,
items, cells, rows and table sections end their like, a cell opens its row, content ends the head. Every visible text goes to the
flow of its nearest list item, cell or the page; hidden elements (scripts, the head, ``hidden``, ``display:none`` and so on) give none.

Flows keep blocks on lines of their own, a blank line around paragraphs, headings, lists and tables, ``- `` or numbers before
items with their later lines indented, line breaks, and preformatted text as it stands. A table's cells are
padded to the width of their columns, with spans over columns and rows; lines longer than WIDEST are broken between words, inside a
cell; a single longer word stays whole and is not padded to, which bounds the padding.

A select shows its chosen option, a list box all of them; a text area its text as it stands. Of drawings the texts show, each on
a line, but no titles, descriptions or definitions (also where a drawing uses them); of formulas the tokens, apart, without annotations.

No recursion, so nesting may be as deep as it likes; a page is held whole, one at a time. Null and empty pages give "". Text
outside of any tag is visible. Attributes that are no numbers count as missing; marked sections are comments. A page that the parser gives up
on has the text between its tags. Equal rows get equal results.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns

WIDEST = 40

# Fixed values of HTML: elements by how they are laid out
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head title script style template noscript datalist iframe object video audio canvas".split())
UNDRAWN = set("desc defs metadata symbol clippath mask pattern marker annotation annotation-xml mphantom".split())  # in svg and math
TOKENS = set("mi mn mo ms mtext".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCKS = SPACED | set("html body div section article header footer nav main aside address form fieldset dt dd li hr tr figcaption details summary center caption".split())
IN_HEAD = set("title meta link base script style template noscript".split())
# what a start tag ends, and the element that the search for it stops at
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
ENDS |= {"thead": ENDS["tbody"], "tfoot": ENDS["tbody"]}
WALLS = {"td", "th", "table", "li"}  # an end tag inside does not reach what is around them

HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBLE = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
NUMBER = re.compile(r"\s*(-?[0-9]{1,9})(?![0-9])")
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # fixed values of HTML: the largest spans
TAG = re.compile(r"<[^>]*>")
ESCAPES = hasattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS")  # parsers that take tags in a text area as text
SPACES = re.compile(r"[ \t\n\r\f]+")


class Flow:
    """Lines of laid-out text."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False  # a blank line is due before the next text
        self.space = False  # a space is due if text goes on in the line

    def add(self, text: str) -> None:
        if text[0] in " \t\n\r\f":
            self.space = True
        words = SPACES.sub(" ", text).strip(" ")
        if words:
            self.put((" " if self.space and self.parts else "") + words)
            self.space = text[-1] in " \t\n\r\f"

    def put(self, text: str) -> None:
        if self.gap and self.lines and not self.parts:
            self.lines.append("")
        self.gap = False
        self.parts.append(text)

    def end_line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced

    def raw(self, text: str) -> None:
        """Text as it stands, over several lines."""
        first, *rest = text.split("\n")
        if first:
            self.put(first)
        for line in rest:
            if self.parts:
                self.end_line()
            elif self.lines:
                self.lines.append("")
            if line:
                self.put(line)

    def take(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self.put(line)
            self.lines.append("".join(self.parts))
            self.parts = []

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Element:
    __slots__ = ("tag", "gone", "faint", "hidden", "flow", "pre", "items", "rows", "within", "bullets", "given")

    def __init__(self, tag: str, gone: bool, flow: Flow, pre: bool, faint: bool = False):
        # what is gone takes all inside with it; what is only not visible may hold visible elements
        self.tag, self.gone, self.faint, self.hidden, self.flow, self.pre = tag, gone, faint, gone or faint, flow, pre
        self.items = self.rows = self.within = self.given = None
        self.bullets = 0


class Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Element("", False, Flow(), False)]
        self.open: dict[str, int] = {}

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if top.hidden:
            return
        if self.open.get("svg") and self.nearest("svg", "text", "foreignobject").tag == "svg":
            return
        if self.open.get("head") and not data.isspace():
            self.end("head")
            top = self.stack[-1]
        if top.tag == "textarea":
            if not top.within:  # the first line end does not show
                top.within, data = True, data.removeprefix("\r").removeprefix("\n")
            data = data.replace("\r\n", "\n")
            top.flow.raw(data if ESCAPES else unescape(data))
        elif top.pre:
            top.flow.raw(data)
        elif data:
            top.flow.add(data)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.open.get("head") and tag not in IN_HEAD and self.stack[-1].tag not in UNSEEN - {"head"}:
            self.end("head")
        if tag in ("select", "input", "textarea") and self.open.get("select"):
            self.end("select", WALLS)
            if tag == "select":
                return
        if tag in BLOCKS and self.open.get("p"):
            self.end("p", WALLS)
        if tag in ENDS:
            self.end_any(*ENDS[tag])
        if tag in ("td", "th") and self.open.get("table") and not self.inside("tr", "table"):
            self.push("tr", False)
        if tag in VOID:
            if not self.stack[-1].hidden:
                flow = self.stack[-1].flow
                if tag == "br":
                    if not flow.parts and flow.lines and not flow.gap:
                        flow.lines.append("")
                    flow.end_line()
                elif tag == "hr":
                    flow.block(True)
            return
        given = {k: v or "" for k, v in attrs}
        closed = tag == "dialog" and "open" not in given
        self.push(tag, closed or "hidden" in given or bool(HIDING.search(given.get("style", ""))), given)
        if tag == "textarea" and not ESCAPES:
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # a slash ends nothing but void elements, and those of drawings and formulas
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (self.open.get("svg") or self.open.get("math")) and self.nearest("svg", "math", "foreignobject").tag != "foreignobject":
            self.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif self.open.get(tag):
            table = tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "ul", "ol", "li", "html", "body")
            self.end(tag, {"table"} if table and tag not in ("table", "html", "body") else (set() if table else WALLS))

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i, report)

    def inside(self, tag: str, stop: str) -> bool:
        for x in reversed(self.stack):
            if x.tag in (tag, stop):
                return x.tag == tag
        return False

    def push(self, tag: str, hidden: bool, given: dict | None = None) -> None:
        top = self.stack[-1]
        foreign = self.open.get("svg") or self.open.get("math")
        stated = VISIBLE.findall((given or {}).get("style", ""))
        faint = stated[-1].lower() != "visible" if stated else top.faint
        gone = top.gone or hidden or tag in UNSEEN or bool(foreign and tag in UNDRAWN)
        x = Element(tag, gone, top.flow, top.pre or tag == "pre", faint)
        x.given = given
        if not x.hidden:
            if foreign:
                if tag == "text" or (tag == "tspan" and given and given.keys() & {"x", "y", "dy"}):
                    top.flow.end_line()
                elif tag in TOKENS:
                    top.flow.space = True
            if tag == "textarea":
                top.flow.end_line()
            if tag == "select":
                x.items, x.flow = [], Flow()  # text outside of options does not show
            if tag == "option" and self.open.get("select"):
                x.flow = Flow()
            if tag in BLOCKS:
                top.flow.block(tag in SPACED and not (tag in ("ul", "ol") and self.open.get("li")))
            if tag in ("li", "td", "th"):
                x.flow = Flow()
            if tag == "table":
                x.rows = []
            if tag == "tr":
                x.items = []
            if tag == "ol":
                x.bullets = number(given, "start", 1)
        self.stack.append(x)
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str, stop: set = frozenset()) -> None:
        for x in reversed(self.stack):
            if x.tag == tag:
                while self.pop().tag != tag:
                    pass
                return
            if x.tag in stop:
                return

    def end_any(self, tags: set, stop: set) -> None:
        if any(self.open.get(t) for t in tags):
            for x in reversed(self.stack):
                if x.tag in stop:
                    return
                if x.tag in tags:
                    while self.pop() is not x:
                        pass

    def nearest(self, *tags: str) -> Element | None:
        return next((x for x in reversed(self.stack) if x.tag in tags), None)

    def pop(self) -> Element:
        x = self.stack.pop()
        self.open[x.tag] -= 1
        flow = self.stack[-1].flow
        if x.hidden:
            return x
        if x.tag == "option" and self.open.get("select"):
            text = (x.given or {}).get("label") or " ".join(x.flow.done())
            of, group = self.nearest("select"), self.nearest("optgroup", "select")
            off = "disabled" in (x.given or {}) or (group.tag == "optgroup" and "disabled" in (group.given or {}))
            of.items.append((text, "selected" in (x.given or {}), off))
        elif x.tag == "select":
            given = x.given or {}
            if "multiple" in given or number(given, "size", 1) > 1:
                flow.take([text for text, _, _ in x.items if text])
            else:
                chosen = [text for text, on, _ in x.items if on][-1:] or [text for text, _, off in x.items if not off][:1]
                if chosen and chosen[0].strip():
                    flow.add(chosen[0])
        elif x.tag == "textarea" or (x.tag == "text" and self.open.get("svg")):
            flow.end_line()
        elif x.tag == "li":
            of, mark = self.nearest("ul", "ol"), "- "
            if of is not None and of.tag == "ol":
                mark, of.bullets = f"{of.bullets}. ", of.bullets + 1
            lines = x.flow.done()
            flow.take([(mark if i == 0 else " " * len(mark) if line else "") + line for i, line in enumerate(lines)])
        elif x.tag in ("td", "th"):
            row, lines = self.nearest("tr"), [line for line in x.flow.done() if line]
            if row is None or row.items is None:
                flow.take(lines)
            else:
                wide, high = number(x.given, "colspan", 1), number(x.given, "rowspan", 1)
                # no rows are the rest of the section; here, of the table
                row.items.append((lines, min(max(1, wide), MOST_COLUMNS), min(high, MOST_ROWS) if high > 0 else MOST_ROWS))
        elif x.tag == "tr" and x.items:
            of = self.nearest("table")
            if of is None or of.rows is None:
                flow.take(aligned([x.items]))
            else:
                of.rows.append(x.items)
        elif x.tag == "table" and x.rows:
            flow.take(aligned(x.rows))
        if x.tag in BLOCKS:
            flow.block(x.tag in SPACED and not (x.tag in ("ul", "ol") and self.open.get("li")))
        return x

    def text(self, html: str) -> str:
        self.feed(html)
        if self.cdata_elem == "textarea":
            self.feed("</textarea>")
        self.close()
        while len(self.stack) > 1:
            self.pop()
        return "\n".join(self.stack[0].flow.done()).strip("\n")


def number(given: dict | None, name: str, other: int) -> int:
    """The number that an attribute begins with, as browsers read it; ``other`` without one of up to nine digits."""
    found = NUMBER.match((given or {}).get(name, ""))
    return int(found[1]) if found else other


def wrapped(line: str) -> list[str]:
    """The line in pieces of up to WIDEST characters, parted between words; longer words are pieces of their own."""
    if len(line) <= WIDEST:
        return [line]
    out = []
    for word in line.split(" "):
        if out and len(out[-1]) + 1 + len(word) <= WIDEST:
            out[-1] += " " + word
        else:
            out.append(word)
    return out


def placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, int, list[str]]]]:
    """Each row's cells as (first column, columns, lines), empty ones where a cell above reaches down."""
    out, below = [], []  # below: (first column, columns, rows left) of cells that reach down, by column
    for row in rows:
        cells, column, waiting = [], 0, sorted(below)
        below = [(c, n, left - 1) for c, n, left in waiting if left > 1]
        for cell in row:
            while waiting and waiting[0][0] <= column:
                c, n, _ = waiting.pop(0)
                cells.append((max(c, column), n, []))
                column = max(c, column) + n
            lines, wide, high = cell
            # a cell is cut short by one that reaches down into its columns
            if waiting and waiting[0][0] < column + wide:
                wide = max(1, waiting[0][0] - column)
            cells.append((column, wide, [piece for line in lines for piece in wrapped(line)]))
            if high > 1:
                below.append((column, wide, high - 1))
            column += wide
        out.append(cells)
    return out


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table's rows: cells (lines, columns, rows) side by side, a cell's own lines below each other."""
    grid = placed(rows)
    wide: dict[int, int] = {}
    for row in grid:
        for column, n, lines in row:
            if n == 1:
                wide[column] = max(wide.get(column, 0), *(min(len(line), WIDEST) for line in lines), 0)
    out = []
    for row in grid:
        sizes = [sum(wide.get(c, 0) for c in range(column, column + n)) + 3 * (n - 1) for column, n, _ in row]
        for k in range(max(1, max(len(lines) for _, _, lines in row))):
            cells = [(lines[k] if k < len(lines) else "").ljust(size) for (_, _, lines), size in zip(row, sizes)]
            out.append(" | ".join(cells).rstrip(" "))
    return out


def visible_text(html: str | None) -> str:
    try:
        return Page().text(html) if html else ""
    except AssertionError:  # the parser's way to give up on a declaration
        return SPACES.sub(" ", unescape(TAG.sub(" ", html))).strip(" ")


def extract_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html`` in the column ``into``."""

    def work(batch: pa.RecordBatch):
        return [pa.array([visible_text(x.as_py()) for x in batch.column(html)], pa.string())]

    return add_columns(pages, html, [T.StructField(into, T.StringType())], work)
