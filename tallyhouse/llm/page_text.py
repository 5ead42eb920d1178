"""Layout-aware text of HTML pages."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import slices

# A tag up to its end; quotes count only behind an equals sign. Nothing is tried twice.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))?)?")
_GONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SIGHT = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
_WHITE = re.compile(r"[ \t\n\r\f]+")

# Bounds of the layout; no text is left out at any of them. Deeper boxes are not indented
# further, cells of deeper tables stand below each other, wider columns are not padded, and
# spans end there.
DEEPEST_INDENT = 64
DEEPEST_TABLE = 16
WIDEST_COLUMN = 80
LONGEST_SPAN = 100

# Facts of the HTML standard, fixed.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
NOT_RENDERED = set(
    "head script style template noscript iframe object canvas audio video title noembed noframes datalist "
    "annotation annotation-xml".split()
)
NOT_RENDERED_IN_SVG = set("defs desc metadata symbol".split())
# Input fields that show their value.
SHOWN_INPUTS = set("text search submit button reset email url tel number".split()) | {""}
# A paragraph is not ended by blocks beyond these.
_CLOSED_SCOPES = ("table", "td", "th", "caption", "button")
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
BLOCKS = PARAGRAPHS | set(
    "address article aside body caption dd details dialog div dt fieldset figcaption footer form header hgroup "
    "html legend li main menu nav optgroup option search section summary tbody td tfoot th thead tr center".split()
)
# An opening tag closes these open elements, up to the first of the second set.
_LISTS, _TABLE = {"ul", "ol", "menu"}, {"table"}
IMPLIED_END: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, _LISTS | _TABLE),
    "dt": ({"dt", "dd"}, {"dl"} | _TABLE),
    "dd": ({"dt", "dd"}, {"dl"} | _TABLE),
    "td": ({"td", "th"}, _TABLE | {"tr"}),
    "th": ({"td", "th"}, _TABLE | {"tr"}),
    "tr": ({"tr", "td", "th", "caption"}, _TABLE),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, _TABLE),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, _TABLE),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, _TABLE),
    "body": ({"head"}, set()),
}


class _Frame:
    """A list item, quotation or definition: its mark stands before its first line."""

    def __init__(self, mark: str, gap: int, blanks: int, first: int):
        self.mark, self.gap, self.blanks, self.first = mark, gap, blanks, first
        self.written = False


class _Flow:
    """Lines of the page or of a table cell. ``gap`` empty lines are due before the next.

    Frames stand in each other; a line is written once, behind the indent of all frames
    that have their mark and the marks of those that don't. Lines are never copied.
    """

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.blanks = 0  # empty lines that were asked for, written if text follows
        self.spaced = True  # white space at the start of a line is dropped
        self.frames: list[_Frame] = []
        self.waiting: list[_Frame] = []  # the innermost frames, without a line so far
        self.indent = 0

    def write(self, text: str, kept: bool) -> None:
        if kept:
            first, *others = text.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            for line in others:
                self.end_line(True)
                self.parts.append(line)
            self.spaced = False
            return
        text = _WHITE.sub(" ", text)
        if self.spaced and text.startswith(" "):
            text = text[1:]
        if text:
            self.parts.append(text)
            self.spaced = text.endswith(" ")

    def end_line(self, forced: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.spaced = [], True
        if line:
            self._add(line)
        elif forced:
            self.blanks += 1

    def _add(self, line: str) -> None:
        gap, blanks = self.gap, self.blanks
        if self.waiting:
            gap = self.waiting[0].gap
            blanks += sum(frame.blanks for frame in self.waiting)
        if self.lines:
            self.lines += [""] * gap
        self.lines += [""] * blanks
        prefix = " " * min(self.indent, DEEPEST_INDENT)
        for frame in self.waiting:
            prefix += frame.mark
            self.indent += len(frame.mark)
            frame.written, frame.first = True, len(self.lines)
        self.waiting = []
        self.gap = self.blanks = 0
        self.lines.append((prefix + line).rstrip(" "))

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def enter(self, mark: str) -> None:
        self.end_line()
        frame = _Frame(mark, self.gap, self.blanks, len(self.lines))
        self.frames.append(frame)
        self.waiting.append(frame)
        self.gap = self.blanks = 0

    def leave(self) -> None:
        """End of the innermost frame; what was due at its end is not any more."""
        self.end_line()
        frame = self.frames.pop()
        if frame.written:
            self.indent -= len(frame.mark)
            self.gap = self.blanks = 0
        else:
            self.waiting.pop()
            self.gap, self.blanks = frame.gap, frame.blanks

    def insert(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            if line:
                self._add(line)
            else:
                self.blanks += 1

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


def _width(text: str) -> int:
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text
    ) if not text.isascii() else len(text)


Cell = tuple[list[str], int, int]  # lines, columns, rows


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, Cell]]]:
    """Cells with their columns, those taken by cells of earlier rows left out."""
    taken: list[int] = []  # by column, the first row that is free again
    out = []
    for number, row in enumerate(rows):
        at, placed = 0, []
        for cell in row:
            while at < len(taken) and taken[at] > number:
                at += 1
            placed.append((at, cell))
            if cell[2] > 1 and at + cell[1] <= LONGEST_SPAN:
                taken += [0] * (at + cell[1] - len(taken))
                taken[at : at + cell[1]] = [number + cell[2]] * cell[1]
            at += cell[1]
        out.append(placed)
    return out


def _aligned(rows: list[list[Cell]]) -> list[str]:
    """Lines of a table: cells side by side, columns as wide as their widest line.

    A cell over several columns widens the last of them where it needs more than they
    have; one over several rows keeps its column free in them.
    """
    placed = _placed(rows)
    widths: dict[int, int] = {}
    for row in placed:
        for at, (lines, columns, _) in row:
            if columns == 1:
                widths[at] = max(widths.get(at, 0), min(max(map(_width, lines), default=0), WIDEST_COLUMN))
    for row in placed:
        for at, (lines, columns, _) in row:
            if columns > 1:
                needed = min(max(map(_width, lines), default=0), WIDEST_COLUMN)
                have = sum(widths.get(at + k, 0) for k in range(columns)) + 2 * (columns - 1)
                last = at + columns - 1
                widths[last] = max(widths.get(last, 0), widths.get(last, 0) + needed - have)
    starts: dict[int, int] = {}
    begin = 0
    for at in range(max(widths, default=-1) + 1):
        starts[at] = begin
        # A column that nothing stands in takes no room.
        begin += widths[at] + 2 if at in widths else 0
    out = []
    for row in placed:
        for number in range(max((len(lines) for _, (lines, _, _) in row), default=0)):
            line, length = [], 0
            for at, (lines, _, _) in row:
                text = lines[number] if number < len(lines) else ""
                if not text:
                    continue
                room = starts.get(at, length) - length
                if room < 2 and line:
                    room = 2
                line.append(" " * max(0, min(room, WIDEST_COLUMN * LONGEST_SPAN)) + text)
                length += max(room, 0) + _width(text)
            out.append("".join(line).rstrip(" "))
    return out


class _Element:
    def __init__(self, tag: str, gone: bool, unseen: bool, kept: bool):
        self.tag, self.gone, self.unseen, self.kept = tag, gone, unseen, kept
        self.frame = False  # whether it holds a frame of the flow
        self.flow: _Flow | None = None  # of cells
        self.rows: list[list[Cell]] | None = None  # of tables
        self.span = (1, 1)
        self.count = 1  # of the next item of an ordered list


def _number(text: str, most: int) -> int:
    return min(max(int(text[:6]), 1), most) if text.isascii() and text.isdigit() else 1


class _Page:
    def __init__(self) -> None:
        self.open = [_Element("", False, False, False)]
        self.flows = [_Flow()]
        self.tables: list[_Element] = []  # open tables whose cells are aligned
        self.where: dict[str, list[int]] = {}  # places of open elements by tag

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of the tags, 0 if there is none."""
        return max((self.where[tag][-1] for tag in tags if self.where.get(tag)), default=0)

    def text(self, text: str) -> None:
        top = self.open[-1]
        if text and not top.gone and not top.unseen:
            self.flows[-1].write(html.unescape(text), top.kept)

    def _imply_ends(self, tag: str) -> None:
        closed, until = IMPLIED_END.get(tag, (set(), set()))
        if closed:
            bound = self.last(*until)
            if tag in ("tr", "thead", "tbody", "tfoot"):  # all of them
                found = [
                    places[bisect_right(places, bound)]
                    for name in closed
                    if (places := self.where.get(name)) and places[-1] > bound
                ]
                if found:
                    self._close(min(found))
            elif (at := self.last(*closed)) > bound:
                self._close(at)
        if tag in BLOCKS and (at := self.last("p")) > self.last(*_CLOSED_SCOPES):
            self._close(at)

    def start(self, tag: str, rest: str) -> None:
        self._imply_ends(tag)
        top, flow = self.open[-1], self.flows[-1]
        given: dict[str, str] = {}
        if rest.strip(" /"):
            for m in _ATTRIBUTE.finditer(rest):
                given.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        style = given.get("style", "")
        gone = (
            top.gone
            or tag in NOT_RENDERED
            or tag in NOT_RENDERED_IN_SVG and self.last("svg") > 0
            or "hidden" in given
            or bool(_GONE.search(style))
        )
        sight = _SIGHT.findall(style)
        unseen = sight[-1].lower() != "visible" if sight else top.unseen
        if tag in VOID:
            if not gone:
                self._void(tag, given, unseen)
            return
        element = _Element(tag, gone, unseen, top.kept or tag in ("pre", "textarea"))
        if not gone:
            if tag in BLOCKS:
                nested = tag in _LISTS and self.last("li") > 0
                flow.block(0 if nested else int(tag in PARAGRAPHS))
            if tag in ("li", "dd", "blockquote"):
                flow.enter(self._mark(tag))
                element.frame = True
            elif tag == "table" and len(self.tables) < DEEPEST_TABLE:
                element.rows = []
                self.tables.append(element)
            elif tag == "tr" and self._in_table():
                self.tables[-1].rows.append([])
            elif tag in ("td", "th") and self._in_table():
                element.flow = _Flow()
                element.span = _number(given.get("colspan", ""), LONGEST_SPAN), _number(given.get("rowspan", ""), 65534)
                self.flows.append(element.flow)
            if tag == "ol" and given.get("start", "").lstrip("-").isdigit():
                element.count = int(given["start"][:9])
            if tag == "optgroup" and not unseen:
                flow.write(given.get("label", ""), False)
                flow.end_line()
        self.where.setdefault(tag, []).append(len(self.open))
        self.open.append(element)

    def _in_table(self) -> bool:
        """Whether the innermost open table is one whose cells are aligned."""
        return bool(self.tables) and self.open[self.last("table")] is self.tables[-1]

    def _mark(self, tag: str) -> str:
        if tag != "li":
            return "  "
        own = self.open[self.last(*_LISTS)]
        if own.tag != "ol":
            return "- "
        own.count += 1
        return f"{own.count - 1}. "

    def _void(self, tag: str, given: dict[str, str], unseen: bool) -> None:
        flow = self.flows[-1]
        if tag == "br":
            flow.end_line(True)
        elif tag == "hr":
            flow.block(1)
        elif tag == "img" and not unseen:
            flow.write(given.get("alt", ""), False)
        elif tag == "input" and not unseen and given.get("type", "").lower() in SHOWN_INPUTS:
            flow.write(given.get("value") or given.get("placeholder", ""), False)

    def end(self, tag: str) -> None:
        at = self.last(tag)
        # A stray end does not leave its table or cell.
        barrier = 0 if tag == "table" else self.last("table") if tag in _CELLS else self.last("table", "td", "th")
        if at > barrier:
            self._close(at)

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            element = self.open.pop()
            self.where[element.tag].pop()
            if element.gone:
                continue
            if element.flow is not None:
                self.flows.pop()
                rows = self.tables[-1].rows
                if not rows:
                    rows.append([])
                rows[-1].append((element.flow.done(), *element.span))
                continue
            flow = self.flows[-1]
            if element.frame:
                flow.leave()
            elif element.rows is not None:
                self.tables.pop()
                flow.insert(_aligned([row for row in element.rows if row]))
            if element.tag in BLOCKS:
                nested = element.tag in _LISTS and self.last("li") > 0
                flow.block(int(element.tag in PARAGRAPHS and not nested))


_CELLS = set("td th tr table tbody thead tfoot".split())


def render(source: str | None) -> str:
    """All visible text of a page, laid out as lines.

    A stack of open elements builds the tree: some tags imply the end of others, void
    elements have none, and stray end tags are passed over. Elements that are not
    rendered (scripts, styles, hidden ones) say nothing; what is visible in an invisible
    element says its own. Blocks start lines of their own, paragraphs, headings, lists
    and tables stand between empty lines, items have marks and indents, and cells of a
    table are aligned, also over several columns and rows. A tag or comment without an
    end takes the rest of the page. Work is in proportion to the page, whatever its
    nesting: indents, columns and nested tables have bounds (above), at which the layout
    gets plainer but no text is lost.
    """
    source, page, at = source or "", _Page(), 0
    begin = 0  # of the text that has not been written yet
    while (at := source.find("<", at)) >= 0:
        following = source[at + 1 : at + 2]
        if following in ("!", "?") or following == "/" and not source[at + 2 : at + 3].isalpha():
            page.text(source[begin:at])
            mark = "-->" if source.startswith("<!--", at) else ">"
            stop = source.find(mark, at + (4 if mark == "-->" else 2))
            begin = at = stop + len(mark) if stop >= 0 else len(source)
            continue
        if not (following == "/" or following.isascii() and following.isalpha()):
            at += 1
            continue
        page.text(source[begin:at])
        found = _TAG.match(source, at)
        if found is None:
            begin = len(source)
            break
        begin = at = found.end()
        tag = found[2].lower()
        if found[1]:
            page.end(tag)
            continue
        page.start(tag, found[3])
        if tag in RAW:  # text up to its own end
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
            stop_at = stop.start() if stop else len(source)
            page.text(source[begin:stop_at])
            begin = at = stop_at
    page.text(source[begin:])
    page._close(1)
    return "\n".join(page.flows[0].done())


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, text) for each row of ``pages`` (page_id, html).

    A null or empty page has an empty text; repeated rows are rendered each; a null
    page_id stays null; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [render(source) for source in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    own = pages.select(F.col("page_id").cast("long"), F.col("html").cast("string"))
    return own.mapInArrow(run, "page_id long, text string")
