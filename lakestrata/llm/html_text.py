"""Layout-aware text of HTML pages.

A tree builder follows the start and end tags, adds the end tags HTML leaves
out (a paragraph ends where a block starts, a list item at the next one, a
cell at the next cell or row, ...) and hands the elements in tree order to a
renderer. That leaves out what a browser does not show, keeps the spacing of
blocks, numbers and indents lists, keeps preformatted text, and sets the cells
of a table in aligned columns. Both work on stacks, so that deep nesting needs
no recursion.

Defined results: a NULL or empty page gives an empty text; broken markup never
fails; repeated rows each come back; an empty table gives no rows. All other
columns are left alone: only the identifier and the HTML are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import Batches, pylist

# Elements by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head title script style template noscript iframe object embed canvas audio video datalist noframes "
    "annotation annotation-xml".split()
)
# Of a drawing the text elements and embedded HTML are shown, but not what these hold.
SVG_HIDDEN = frozenset("desc metadata defs symbol clippath mask pattern marker".split())
SVG_SHOWN = ("text", "foreignobject")
# Elements of formulas and drawings set apart by a space.
APART = frozenset("math mi mn mo ms mtext text".split())
# Fields that show their value.
VALUE_SHOWN = frozenset("button submit reset text search email url tel number".split())
# Blocks set off by an empty line, and those that only start a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset menu dir".split())
PLAIN = frozenset(
    "html body div section article nav aside header footer main address form li dt dd center details summary dialog "
    "figcaption legend caption thead tbody tfoot tr td th search hgroup".split()
)
BLOCK = SPACED | PLAIN
# A start tag of the second set ends an open element of the first, unless one of the third lies between.
IMPLIED = [
    ({"p"}, BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "legend"}, {"td", "th", "table", "button", "caption", "object"}),
    ({"li"}, {"li"}, {"ul", "ol", "menu", "dir", "table"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl", "table"}),
    ({"option"}, {"option", "optgroup"}, {"select"}),
    ({"optgroup"}, {"optgroup"}, {"select"}),
    ({"td", "th"}, {"td", "th", "tr", "thead", "tbody", "tfoot"}, {"table"}),
    ({"tr"}, {"tr", "thead", "tbody", "tfoot"}, {"table"}),
    ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"thead", "tbody", "tfoot"}, {"table"}),
    ({"caption", "colgroup"}, {"tr", "td", "th"}, {"table"}),
    ({"head"}, BLOCK | {"a", "b", "i", "span", "img", "input"}, {"html"}),
]
ENDS = {tag: [(open_, stops) for open_, starts, stops in IMPLIED if tag in starts] for tag in BLOCK | {"option", "optgroup", "a", "b", "i", "span", "img", "input"}}
# Elements an end tag inside does not reach past.
SCOPE = frozenset("table td th caption html".split())

_SPACE = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?<![-\w])visibility\s*:\s*(hidden|collapse|visible|initial)", re.IGNORECASE)


def is_hidden(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag in HIDDEN or "hidden" in attrs or (tag == "dialog" and "open" not in attrs):
        return True
    return bool(_INVISIBLE.search(attrs.get("style") or ""))


def is_visible(attrs: dict[str, str | None], inherited: bool) -> bool:
    """Whether an element's text is seen; unlike a hidden element, one that is
    not may hold others that are."""
    said = _VISIBILITY.findall(attrs.get("style") or "")
    return said[-1].lower() in ("visible", "initial") if said else inherited


def width(text: str) -> int:
    """Columns a text takes in a fixed-width font."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Text set line by line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.current: list[str] = []
        self.gap = 0  # empty lines due before the next text
        self.space = False
        self.indent: list[str] = []
        self.mark: str | None = None

    def text(self, data: str, keep: bool) -> None:
        if keep:
            for k, line in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if k:
                    self.line_break()
                if line:
                    self._put(line)
            return
        words = _SPACE.sub(" ", data)
        if words[:1] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        trailing = words[-1] == " "
        self._put(words[:-1] if trailing else words)
        self.space = trailing

    def _put(self, data: str) -> None:
        if not self.current:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            prefix = "".join(self.indent)
            if self.mark is not None:
                prefix = prefix[: len(prefix) - len(self.mark)] + self.mark
                self.mark = None
            self.current.append(prefix)
        elif self.space:
            self.current.append(" ")
        self.space = False
        self.current.append(data)

    def end_line(self) -> None:
        if self.current:
            self.lines.append("".join(self.current).rstrip(" "))
            self.current = []
        self.space = False

    def line_break(self) -> None:
        if self.current:
            self.end_line()
        elif self.lines:
            self.gap += 1

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.mark is None:
            self.gap = max(self.gap, 1)

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []
        self.caption: list[str] = []

    def set(self) -> list[str]:
        """The rows as lines; a column is as wide as its widest cell."""
        widths: list[int] = []
        for row in self.rows:
            at = 0
            for lines, span in row:
                widths += [0] * (at + span - len(widths))
                if span == 1:
                    widths[at] = max(widths[at], max(map(width, lines), default=0))
                at += span
        out = list(self.caption)
        for row in self.rows:
            for k in range(max((len(lines) for lines, _ in row), default=0)):
                at, parts = 0, []
                for lines, span in row:
                    cell = lines[k] if k < len(lines) else ""
                    room = sum(widths[at : at + span]) + 2 * (span - 1)
                    parts.append(cell + " " * max(0, room - width(cell)))
                    at += span
                out.append("  ".join(parts).rstrip(" "))
        return out


class _Page(HTMLParser):
    """Tree builder and renderer of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # tag, hidden
        self.names: Counter[str] = Counter()  # of the open elements: most searches need not look
        self.visible: list[bool] = []  # of the open elements
        self.hidden = 0
        self.pre = 0
        self.contexts: list[_Lines] = [_Lines()]
        self.tables: list[_Table] = []
        self.lists: list[list] = []
        self.closed_details = 0

    def handle_starttag(self, tag: str, attributes) -> None:
        for open_, stops in ENDS.get(tag, ()):
            if not any(self.names[name] for name in open_):
                continue
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if name in open_:
                    self._close_to(k)
                    break
                if name in stops:
                    break
        if tag in ("td", "th") and not self._in_row():
            self.handle_starttag("tr", [])
        if tag == "tr" and not self._in_table():
            self.handle_starttag("table", [])
        attrs = dict(attributes)
        hidden = is_hidden(tag, attrs) or self._in_closed_details(tag) or (tag in SVG_HIDDEN and self._in_drawing())
        visible = is_visible(attrs, not self.visible or self.visible[-1])
        if tag in VOID:
            if visible and not hidden and not self.hidden:
                self._void(tag, attrs)
            return
        self.open.append((tag, hidden))
        self.visible.append(visible)
        self.hidden += hidden
        if tag == "details":
            self.open[-1] = ("details" if "open" in attrs else "details-closed", hidden)
        self.names[tag] += 1
        if not self.hidden:
            self._enter(tag, attrs)

    def _in_closed_details(self, tag: str) -> bool:
        return tag != "summary" and bool(self.open) and self.open[-1][0] == "details-closed"

    def handle_startendtag(self, tag: str, attributes) -> None:
        foreign = tag in ("svg", "math") or ((self.names["svg"] or self.names["math"]) and not self.names["foreignobject"])
        self.handle_starttag(tag, attributes)
        # HTML reads the slash in formulas and drawings only.
        if foreign and tag not in VOID and self.open[-1][0] == tag:
            self._close_to(len(self.open) - 1)

    def _in_drawing(self) -> bool:
        return self.names["svg"] > 0 and not self.names["foreignobject"]

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._void("br", {}) if not self.hidden and (not self.visible or self.visible[-1]) else None
            return
        if not self.names[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0].removesuffix("-closed")
            if name == tag:
                self._close_to(k)
                return
            if name in SCOPE and tag not in ("table", "tr", "thead", "tbody", "tfoot", "html", "body"):
                return
            if name == "table":
                return

    def handle_data(self, data: str) -> None:
        if self.hidden or (self.open and self.open[-1][0] == "details-closed"):
            return
        if self.visible and not self.visible[-1]:
            return
        if self.names["svg"] and not any(self.names[name] for name in SVG_SHOWN):
            return
        # Text of a table outside its cells stands before the table.
        if self.tables and self._loose() and not data.strip():
            return
        self.contexts[-1].text(data, self.pre > 0)

    def _loose(self) -> bool:
        for name, _ in reversed(self.open):
            if name in ("td", "th", "caption"):
                return False
            if name == "table":
                return True
        return False

    def _in_row(self) -> bool:
        return self._inside("tr")

    def _in_table(self) -> bool:
        return self._inside("table")

    def _inside(self, tag: str) -> bool:
        for name, _ in reversed(self.open):
            if name == tag:
                return True
            if name in ("td", "th", "caption", "table"):
                return False
        return False

    def _close_to(self, k: int) -> None:
        while len(self.open) > k:
            tag, hidden = self.open.pop()
            self.visible.pop()
            tag = tag.removesuffix("-closed")
            self.names[tag] -= 1
            if not self.hidden:
                self._leave(tag)
            self.hidden -= hidden

    def _void(self, tag: str, attrs: dict) -> None:
        if tag == "br":
            self.contexts[-1].line_break()
        elif tag == "hr":
            self.contexts[-1].block(True)
        elif tag == "input" and (attrs.get("type") or "text").strip().lower() in VALUE_SHOWN and attrs.get("value"):
            self.contexts[-1].text(f" {attrs['value']} ", False)

    def _enter(self, tag: str, attrs: dict) -> None:
        out = self.contexts[-1]
        if tag in ("td", "th", "caption"):
            self.contexts.append(_Lines())
            if tag != "caption":
                span = attrs.get("colspan") or "1"
                span = min(int(span), 1000) if span.isascii() and span.isdigit() and int(span) else 1
                self.tables[-1].rows[-1].append(([], span))
        elif tag == "tr":
            self.tables[-1].rows.append([])
        elif tag == "table":
            out.block(True)
            self.tables.append(_Table())
        elif tag in ("thead", "tbody", "tfoot", "colgroup"):
            pass
        elif tag in ("ul", "ol", "menu", "dir"):
            out.block(not self.lists)
            start = attrs.get("start") or "1"
            self.lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start, re.ASCII) else 1, out])
        elif tag == "li":
            out.block(False)
            mark = "- "
            if self.lists and self.lists[-1][0]:
                value = attrs.get("value") or ""
                if re.fullmatch(r"-?\d{1,9}", value, re.ASCII):
                    self.lists[-1][1] = int(value)
                mark = f"{self.lists[-1][1]}. "
                self.lists[-1][1] += 1
            out.indent.append(" " * len(mark))
            out.mark = mark
        elif tag in ("dd", "blockquote"):
            out.block(tag == "blockquote")
            out.indent.append("  ")
        elif tag in BLOCK:
            out.block(tag in SPACED)
            self.pre += tag == "pre"
        elif tag == "textarea":
            self.pre += 1
        elif tag in APART and (self.names["math"] or self.names["svg"]):
            out.space = True

    def _leave(self, tag: str) -> None:
        if tag in ("td", "th", "caption"):
            lines = self.contexts.pop().result()
            if tag == "caption":
                self.tables[-1].caption = lines
            else:
                self.tables[-1].rows[-1][-1][0].extend(lines)
            return
        out = self.contexts[-1]
        if tag == "table":
            out.block(True)
            for line in self.tables.pop().set():
                if line:
                    out.text(line, True)
                    out.end_line()
            out.block(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
            out.block(not self.lists)
        elif tag == "li":
            out.end_line()
            out.indent.pop()
            out.mark = None
        elif tag in ("dd", "blockquote"):
            out.block(tag == "blockquote")
            out.indent.pop()
        elif tag in BLOCK and tag not in ("tr", "thead", "tbody", "tfoot"):
            out.block(tag in SPACED)
            self.pre -= tag == "pre"
        elif tag == "textarea":
            self.pre -= 1
        elif tag == "svg":
            out.space = True


def page_text(html: str) -> str:
    """The visible text of a page, laid out in lines."""
    page = _Page()
    page.feed(html)
    # A tag that the page ends in is no text.
    if re.match(r"<[a-zA-Z/!?]", page.rawdata):
        page.rawdata = ""
    page.close()
    page._close_to(0)
    return "\n".join(page.contexts[0].result())


def extract(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``text`` of every page."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [page_text(h) for h in pylist(batch, "_html")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    source = pages.select(F.col(f"`{key}`"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("_html"))
    kind = source.schema[key].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, text string")
