"""Visible text of HTML pages, laid out.

A tree builder closes and opens the tags that HTML lets authors leave out;
visibility rules drop what a browser doesn't show; a renderer writes the rest
with blank lines between paragraphs, list markers and aligned table cells. Style
sheets aren't evaluated, only `style` and `hidden` attributes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlwarden.llm.common import schema_like

DEEPEST = 200  # elements nested deeper stand beside the innermost, as browsers do; hidden ones keep as many more
WIDEST = 60  # a cell longer than this doesn't widen its column

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
UNENDED = re.compile(r"<[a-zA-Z/!?]")
SPACES = re.compile(r"[ \t\n\f\r]+")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.IGNORECASE)

VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
DECODED = frozenset("textarea title".split())  # raw, but for character references
UNSEEN = frozenset(
    "head script style template noscript title iframe object audio video canvas noembed noframes datalist "
    "annotation annotation-xml".split())
DRAWN = frozenset(("text", "foreignobject"))  # what shows text in an image
UNDRAWN = frozenset("desc metadata defs symbol clippath mask marker pattern".split())
FOREIGN = frozenset(("svg", "math"))
LEAVES_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var".split())
HTML_WITHIN = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
SELF_CLOSED = re.compile(r"(?:^|[\s\"']|(?:^|\s)[^\s=\"']+)/\Z")
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr menu fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside center dd details dialog dir div dt figcaption footer form header hgroup legend li main nav "
    "optgroup option search section summary caption tr tbody thead tfoot".split())
NOT_IN_P = (SPACED | BLOCKS) - frozenset("html body option optgroup tr tbody thead tfoot caption legend".split())
# Opening the key closes an open element of these, unless one of the walls stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
    **{group: ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}) for group in ("tbody", "thead", "tfoot")},
    "body": ({"head"}, set()),
}
CELL_WALLS = frozenset(("td", "th", "table", "caption"))
GROUPS = frozenset(("tbody", "thead", "tfoot"))
HEAD_PARTS = frozenset("title meta link base script style template noscript".split())


class Element:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        """Value of the first attribute of that name, empty if it has none."""
        if name not in self.attributes.lower():
            return None
        for key, *values in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape("".join(values))
        return None

    def number(self, name: str, otherwise: int) -> int:
        found = re.match(r"\s*([+-]?\d{1,6})", self.attribute(name) or "")
        return int(found[1]) if found else otherwise


class Builder:
    """Open elements, from the root inwards."""

    def __init__(self):
        self.open = [Element("html")]

    def close_down_to(self, place: int) -> None:
        del self.open[place:]

    def find(self, tags: set[str] | frozenset[str], walls: set[str] | frozenset[str] = frozenset()) -> int:
        """Place of the innermost open element of ``tags``, 0 if a wall or nothing comes first."""
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in tags:
                return place
            if tag in walls:
                return 0
        return 0

    def push(self, element: Element) -> None:
        self.open[-1].children.append(element)
        if element.tag not in VOID:
            self.open.append(element)
            if len(self.open) > DEEPEST and not (len(self.open) <= 2 * DEEPEST and (is_hidden(element) or len(self.open) > DEEPEST + 1)):
                del self.open[-1]

    def start(self, tag: str, attributes: str) -> None:
        if tag == "html":
            return
        if tag in LEAVES_FOREIGN and (place := self.find(FOREIGN, HTML_WITHIN)):
            self.close_down_to(place)
        if tag not in HEAD_PARTS and tag != "head" and (head := self.find({"head"})):
            self.close_down_to(head)
        if tag in NOT_IN_P and (place := self.find({"p"}, CELL_WALLS | {"button", "object"})):
            self.close_down_to(place)
        if tag in CLOSES:
            tags, walls = CLOSES[tag]
            if place := self.find(tags, walls):
                self.close_down_to(place)
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" and self.open[-1].tag[0] == "h" and self.open[-1].tag[1:] in "123456":
            self.close_down_to(len(self.open) - 1)
        inner = self.open[-1].tag
        if tag == "a" and (place := self.find({"a"}, CELL_WALLS)):
            self.close_down_to(place)
        elif tag in ("td", "th") and inner != "tr" and self.find({"table"}):
            if inner not in GROUPS:
                self.table_body()
            self.push(Element("tr"))
        elif tag == "tr" and inner not in GROUPS and self.find({"table"}):
            self.table_body()
        self.push(Element(tag, attributes))

    def table_body(self) -> None:
        """The body that a row without one implies."""
        if place := self.find(GROUPS, {"table"}):
            self.close_down_to(place + 1)
        else:
            self.close_down_to(self.find({"table"}) + 1)
            self.push(Element("tbody"))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.push(Element("br"))
            return
        walls = frozenset() if tag in CELL_WALLS or tag in ("tr", "table", "body") or tag in GROUPS else CELL_WALLS
        if place := self.find({tag}, walls):
            self.close_down_to(place)
        elif tag == "p":
            self.start("p", "")
            self.close_down_to(len(self.open) - 1)

    def text(self, text: str) -> None:
        if not text:
            return
        if not text.isspace() and (head := self.find({"head"})):
            self.close_down_to(head)
        self.open[-1].children.append(text)


def parse(html: str) -> Element:
    builder, at, last = Builder(), 0, html.rfind(">") + 1  # no tag ends behind that
    while found := TOKEN.search(html, at, last):
        if found.start() > at:
            builder.text(decoded(html[at:found.start()]))
        at = found.end()
        if found[1]:
            builder.end(found[1].lower())
        elif found[2]:
            tag = found[2].lower()
            builder.start(tag, found[3])
            own = builder.open[-1]
            if own.tag == tag and SELF_CLOSED.search(found[3]) and builder.find(FOREIGN, {"foreignobject"}):
                builder.close_down_to(len(builder.open) - 1)
            elif tag in RAW:
                own = own if own.tag == tag else own.children[-1]  # too deep to be open
                close = re.compile(f"</{tag}(?=[\\s/>])|\\Z", re.IGNORECASE).search(html, at)
                text = html[at:close.start()]
                if text:
                    own.children.append(decoded(text) if tag in DECODED else text)
                at = close.start()
        elif found[0].startswith("<!--") and not found[0].endswith(("-->", "--!>", "<!--->")):
            at = len(html)  # a comment that nothing ends
    rest = html[at:]
    cut = UNENDED.search(rest)
    builder.text(decoded(rest[:cut.start()] if cut else rest))
    return builder.open[0]


def decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


def is_hidden(element: Element) -> bool:
    if element.tag in UNSEEN:
        return True
    if not element.attributes:
        return element.tag == "dialog"
    lower = element.attributes.lower()
    if "hidden" in lower and element.attribute("hidden") not in (None, "until-found"):
        return True
    if "style" in lower and HIDING.search(element.attribute("style") or ""):
        return True
    return element.tag == "dialog" and element.attribute("open") is None


class Page:
    """Lines written so far, and what must come before the next word."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # line ends due: 1 a new line, 2 a blank line besides
        self.space = False
        self.indent = ""
        self.marker = ""

    def end_line(self) -> None:
        self.lines.append("".join(self.line).rstrip(" "))
        self.line = []

    def block(self, gap: int) -> None:
        self.gap = max(self.gap, gap)
        self.space = False

    def begin(self) -> None:
        """Whatever is due before text."""
        if self.gap:
            if self.line:
                self.end_line()
            if self.gap > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = 0
        if not self.line:
            self.line.append(self.indent[:len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent)
            self.marker = ""
            self.space = False

    def words(self, text: str) -> None:
        text = SPACES.sub(" ", text)
        body = text.strip(" ")
        if not body:
            self.space = self.space or bool(text)
            return
        lead = self.space or text[0] == " "
        fresh = self.gap or not self.line
        self.begin()
        if lead and not fresh:
            self.line.append(" ")
        self.line.append(body)
        self.space = text[-1] == " "

    def new_line(self) -> None:
        self.begin()
        self.end_line()
        self.space = False

    def verbatim(self, text: str) -> None:
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.new_line()
            if part:
                self.begin()
                self.line.append(part)

    def text(self) -> str:
        if self.line:
            self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def walk(element: Element, page: Page, verbatim: bool = False) -> None:
    for child in element.children:
        if isinstance(child, str):
            if verbatim:
                page.verbatim(child)
            else:
                page.words(child)
            continue
        tag = child.tag
        if is_hidden(child):
            continue
        if tag == "br":
            page.new_line()
        elif tag == "table":
            page.block(2)
            table(child, page)
            page.block(2)
        elif tag == "svg":
            drawing(child, page)
        elif tag in ("ul", "ol", "menu", "dir"):
            listing(child, page)
        elif tag == "blockquote" or tag == "dd":
            page.block(2 if tag == "blockquote" else 1)
            page.indent += "  "
            walk(child, page)
            page.block(2 if tag == "blockquote" else 1)
            page.indent = page.indent[:-2]
        elif tag in ("pre", "textarea", "xmp", "listing"):
            page.block(2 if tag == "pre" else 0)
            first = child.children[0] if child.children else None
            if isinstance(first, str) and first.startswith("\n"):
                child.children[0] = first[1:]
            walk(child, page, True)
            page.block(2 if tag == "pre" else 0)
        elif tag == "details" and child.attribute("open") is None:
            page.block(1)
            summary = next((c for c in child.children if isinstance(c, Element) and c.tag == "summary"), None)
            if summary:
                walk(summary, page)
            page.block(1)
        elif tag in ("td", "th"):  # outside a table
            page.words(" ")
            walk(child, page)
            page.words(" ")
        else:
            gap = 2 if tag in SPACED else 1 if tag in BLOCKS else 0
            if gap:
                page.block(gap)
            walk(child, page, verbatim)
            if gap:
                page.block(gap)


def drawing(element: Element, page: Page) -> None:
    """Text of an image, each piece as words of their own."""
    for child in element.children:
        if isinstance(child, str) or child.tag in UNDRAWN or is_hidden(child) or child.attribute("display") == "none":
            continue
        if child.tag in DRAWN:
            page.words(" ")
            walk(child, page)
            page.words(" ")
        else:
            drawing(child, page)


def listing(element: Element, page: Page) -> None:
    gap = 1 if page.indent or page.marker else 2
    page.block(gap)
    number = element.number("start", 1)
    for child in element.children:
        if isinstance(child, str):
            page.words(child)
        elif not is_hidden(child):
            marker = "- "
            if element.tag == "ol" and child.tag == "li":
                number = child.number("value", number)
                marker = f"{number}. "
                number += 1
            before, waiting = page.indent, page.marker
            page.block(1)
            if child.tag == "li":
                page.indent, page.marker = before + " " * len(marker), marker
            walk(child if child.tag == "li" else alone(child), page)
            page.indent = before
            page.marker = waiting if page.marker else ""
            page.block(1)
    page.block(gap)


def alone(child: Element) -> Element:
    """An element that has only this child."""
    wrapper = Element("wrapper")
    wrapper.children.append(child)
    return wrapper


def table_rows(element: Element) -> Iterator[Element]:
    for child in element.children:
        if isinstance(child, Element) and not is_hidden(child):
            if child.tag == "tr":
                yield child
            elif child.tag in GROUPS:
                yield from table_rows(child)


def strays(element: Element) -> Iterator[Element | str]:
    """What doesn't belong in a table or its row groups, and captions; browsers show it in front of the rows."""
    for child in element.children:
        if isinstance(child, str):
            if element.tag == "table" or not child.isspace():
                yield child
        elif child.tag in GROUPS:
            if not is_hidden(child):
                yield from strays(child)
        elif child.tag not in ("tr", "colgroup", "col") and not is_hidden(child):
            yield child


def rendered(element: Element) -> str:
    page = Page()
    walk(element, page)
    return page.text()


def table(element: Element, page: Page) -> None:
    """Cells side by side, columns padded to their widest cell of up to ``WIDEST``."""
    for child in strays(element):
        if isinstance(child, str):
            page.words(child)
        else:
            page.block(1)
            walk(alone(child), page)
            page.block(1)
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # column: rows that a cell from above still takes
    widths: dict[int, int] = {}
    for row in table_rows(element):
        cells, column = [], 0
        here = {k for k, n in taken.items() if n}
        taken = {k: n - 1 for k, n in taken.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, str):
                if cell.isspace():
                    continue
                cell_element, span, rows = Element("td"), 1, 1
                cell_element.children.append(cell)
            elif is_hidden(cell):
                continue
            else:
                cell_element = cell
                span, rows = min(max(1, cell.number("colspan", 1)), 1000), min(max(1, cell.number("rowspan", 1)), 65534)
            while column in here:
                column += 1
            lines = rendered(cell_element).split("\n")
            cells.append((column, span, lines))
            if span == 1:
                widths[column] = max(widths.get(column, 0), max((len(x) for x in lines if len(x) <= WIDEST), default=0))
            if rows > 1:
                taken |= {k: rows - 1 for k in range(column, column + span)}
            column += span
        if cells:
            grid.append(cells)
    if not grid:
        return
    starts, at = {}, 0
    for column in range(max(c for row in grid for c, _, _ in row) + 1):
        starts[column] = at
        at += widths.get(column, 0) + 2 if column in widths else 0
    page.block(1)
    for cells in grid:
        for k in range(max(len(lines) for _, _, lines in cells)):
            line, filled = "", False
            for column, _, lines in cells:
                part = lines[k] if k < len(lines) else ""
                if part:
                    line = line.ljust(starts[column]) if not filled else line.ljust(max(starts[column], len(line) + 2))
                    line += part
                    filled = True
            if filled:
                page.verbatim(line)
            page.block(1 if filled else 2)


def page_text(html: str) -> str:
    """All that the page shows. Text without a tag is its own text, with white space collapsed."""
    return rendered(parse(html))


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col, text, n_chars``: one row per row. A null page has a null text and no
    characters, an empty one an empty text. Rows with equal ids stay apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if html is None else page_text(html) for html in batch.column(1).to_pylist()]
            sizes = [len(text or "") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=schema.fieldNames())

    wanted = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    schema = schema_like(wanted, {id_col: "id"}, [("text", "string"), ("n_chars", "bigint")])
    return wanted.mapInArrow(run, schema)
