"""HTML extraction by layout-aware rendering.

A tree builder keeps the stack of open elements: void elements, implied end tags (p, li, dt, dd, option,
table rows and cells, head), end tags that match nothing, elements left open.  An element is shown unless it or
one around it is not displayed (``hidden``, ``display:none``, closed dialogs, head, scripts, styles, templates);
``visibility`` hides text, too, but an element within may be visible again.  Both are read from attributes and
from the page's style elements, where a rule's selector names a tag, classes and an id (selectors that look at
other elements, and media other than screens, are passed over).  Visible text is laid out as it is read: white
space collapses but in ``pre``; blocks start lines and some leave a blank one; list items get a bullet or their
number and hang; table cells stand in columns, with those that span rows and columns keeping theirs.  A cell
that others follow is wrapped at ``WIDEST`` characters, so that every column has a width.

Nothing recurses and each page is read once (twice if it has style elements), so depth and length don't matter.

Defined results: a null or empty page gives an empty text; text outside any tag is visible; an unclosed tag
or comment runs to the page's end; repeated rows get their rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .tokens import text_parts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes datalist".split())
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Blocks that leave a blank line, and those that only start a line.
SPACED = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl menu blockquote pre table figure hr".split())
BLOCK = SPACED | frozenset("html body div section article aside nav header footer main address form fieldset legend details summary dialog li dt dd tr caption center figcaption hgroup search option optgroup thead tbody tfoot".split())
CLOSES_P = BLOCK - frozenset("html body option optgroup tr caption thead tbody tfoot legend".split())
#: A start tag ends these open elements, unless one of the barriers stands between.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu table".split())),
    "dt": (frozenset("dt dd".split()), frozenset("dl table".split())),
    "dd": (frozenset("dt dd".split()), frozenset("dl table".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset("select datalist".split())),
    "tr": (frozenset("tr caption".split()), frozenset(["table"])),
    "td": (frozenset("td th caption".split()), frozenset(["table"])),
    "th": (frozenset("td th caption".split()), frozenset(["table"])),
    "thead": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot caption".split()), frozenset(["table"])),
}
CELLS = frozenset("td th caption".split())
#: Cells that others follow are wrapped at so many characters; words stay whole up to LONGEST.
WIDEST, LONGEST = 60, 240
#: Columns that a table is laid out in; cells further right follow one another.
COLUMNS = 5000

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(?P<odd>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'<>/=]++)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SELECTOR = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Sheet:
    """Lines being laid out."""

    def __init__(self):
        self.out: list[str] = []
        self.need = 0  # line breaks due before the next text
        self.space = False
        self.indent = self.marker = ""

    def block(self, breaks: int) -> None:
        if not self.marker:  # what a list item begins with stands beside its marker
            self.need = max(self.need, breaks)
        self.space = False

    def put(self, text: str) -> None:
        fresh = not self.out or bool(self.need)
        if self.need and self.out:
            self.out.append("\n" * self.need)
        if fresh:
            self.out.append(self.marker or self.indent)
            self.marker = ""
        elif self.space:
            self.out.append(" ")
        self.need, self.space = 0, False
        self.out.append(text)

    def flow(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        if words[:1] == " ":
            self.space = True
        core = words.strip(" ")
        if core:
            self.put(core)
            self.space = words[-1] == " "

    def lines(self, text: str) -> None:
        for k, line in enumerate(text.split("\n")):
            if k:
                self.need, self.space = (self.need + 1 if self.out or self.need else 0), False
            if line:
                self.put(line)

    def text(self) -> str:
        return "\n".join(line.rstrip() for line in "".join(self.out).split("\n")).strip("\n")


def wrapped(text: str) -> list[str]:
    """Lines of at most WIDEST characters, but for longer words, which are cut at LONGEST."""
    out = []
    for line in text.split("\n"):
        if len(line) <= WIDEST:
            out.append(line)
            continue
        held = ""
        for word in line.split(" "):
            for at in range(0, len(word) or 1, LONGEST):
                part = word[at : at + LONGEST]
                if held and (at or len(held) + 1 + len(part) > WIDEST):
                    out.append(held)
                    held = part
                else:
                    held = f"{held} {part}" if held else part
        out.append(held)
    return out


class Table:
    def __init__(self):
        self.rows: list[list[tuple[int, int, str]]] = []  # (column, columns it spans, text)
        self.taken: dict[int, int] = {}  # column -> first row in which it is free
        self.column = 0

    def row(self) -> None:
        self.rows.append([])
        self.column = 0

    def cell(self, text: str, span: int, down: int) -> None:
        if not self.rows:
            self.row()
        row = len(self.rows) - 1
        while self.taken.get(self.column, 0) > row:
            self.column += 1
        first, self.column = self.column, min(self.column + span, COLUMNS)
        self.rows[-1].append((first, max(1, self.column - first), text))
        if down > 1:
            self.taken.update(dict.fromkeys(range(first, self.column), row + down))

    def render(self) -> str:
        n = max((column + span for row in self.rows for column, span, _ in row), default=0)
        widths, cells, spanning = [0] * n, [], []
        for row in self.rows:
            cells.append([(column, span, wrapped(text) if k + 1 < len(row) else text.split("\n")) for k, (column, span, text) in enumerate(row)])
            for column, span, lines in cells[-1]:
                wide = max(map(len, lines))
                if column + span < n and span == 1:
                    widths[column] = max(widths[column], wide)
                elif column + span < n:
                    spanning.append((span, column, wide))
        begun, offset = {column for row in self.rows for column, _, _ in row}, [0]
        for span, column, wide in sorted(spanning):
            room = sum(widths[column : column + span]) + 2 * sum(c in begun for c in range(column + 1, column + span))
            widths[column + span - 1] += max(0, wide - room)
        for column, wide in enumerate(widths):  # a column in which no cell begins is part of the one before
            offset.append(offset[-1] + wide + 2 * (column + 1 in begun))
        out = []
        for row in cells:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(offset[column]) if len(line) <= max(0, offset[column] - 2) else line + "  "
                        line += lines[k]
                out.append(line.rstrip())
        return "\n".join(line for line in out if line)


class Rules:
    """What a page's style elements say about display and visibility."""

    def __init__(self):
        self.by: dict[str, dict[tuple, tuple]] = {}  # a selector's rarest part -> what each selector with it declares
        self.n = 0

    def read(self, css: str) -> None:
        css = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", css, flags=re.S)
        selectors, at, skip, depth = None, 0, 0, 0  # depth of open blocks, and the depth at which skipping began
        for found in re.finditer(r"[{};]", css):
            mark, head = found[0], css[at : found.start()].strip()
            if mark == ";" and (depth == 0 or skip):
                at = found.end()  # a statement such as @import; within a block it is read whole
            elif mark == "{":
                at, depth = found.end(), depth + 1
                if not skip and head.startswith("@"):
                    screen = re.match(r"@media\b", head, re.I) and re.search(r"\b(?:screen|all)\b", head, re.I) and not re.search(r"\bnot\b", head, re.I)
                    skip = 0 if screen else depth
                    selectors = None
                elif not skip:
                    selectors = head
            elif mark == "}":
                if not skip and depth and selectors is not None:
                    self._add(selectors, head)
                selectors = None
                if skip == depth:
                    skip = 0
                at, depth = found.end(), max(0, depth - 1)

    def _add(self, selectors: str, body: str) -> None:
        declared = [(name.lower(), value.lower(), bool(strong)) for name, value, strong in _DECLARED.findall(body)]
        if not declared:
            return
        for selector in selectors.split(","):
            found = _SELECTOR.fullmatch(selector.strip())
            if not found or not found[0]:
                continue
            tag, parts = (found[1] or "*").lower(), re.findall(r"[.#][\w-]+", found[2])
            ids, classes = (frozenset(p[1:] for p in parts if p[0] == mark) for mark in "#.")
            weight = (len([p for p in parts if p[0] == "#"]), len([p for p in parts if p[0] == "."]), tag != "*")
            for name, value, strong in declared:
                self.n += 1
                rank, own = (strong, 0, weight, self.n), self.by.setdefault(parts[0] if parts else tag, {})
                if rank > own.get((tag, ids, classes, name), ((),))[0]:  # the same selector's earlier word no longer counts
                    own[tag, ids, classes, name] = rank, value

    def told(self, tag: str, given: dict[str, str]) -> dict[str, str]:
        """display and visibility of an element, as far as it or a rule declares them."""
        best: dict[str, tuple] = {}
        if self.by:
            own_id, own = given.get("id", ""), set(given.get("class", "").split())
            for key in ("*", tag, "#" + own_id, *("." + c for c in own)):
                for (wanted, ids, classes, name), (rank, value) in self.by.get(key, {}).items():
                    if wanted in ("*", tag) and ids <= {own_id} and classes <= own and rank >= best.get(name, (rank,))[0]:
                        best[name] = (rank, value)
        for k, (name, value, strong) in enumerate(_DECLARED.findall(given.get("style", ""))):
            rank = (bool(strong), 1, (), k)
            if rank >= best.get(name.lower(), (rank,))[0]:
                best[name.lower()] = (rank, value.lower())
        return {name: value for name, (_, value) in best.items()}


class Frame:
    __slots__ = ("tag", "shown", "visible", "sheet", "table", "pre", "indent", "number", "span", "marker")

    def __init__(self, tag, shown, visible, sheet, table, pre, indent):
        self.tag, self.shown, self.visible, self.sheet, self.table, self.pre, self.indent = tag, shown, visible, sheet, table, pre, indent
        self.number, self.span, self.marker = None, (1, 1), ""


class Page:
    """The open elements of one page, and where their text goes."""

    def __init__(self, rules: Rules):
        self.sheet, self.rules = Sheet(), rules
        self.open = [Frame("", True, True, self.sheet, None, False, "")]
        self.many: dict[str, int] = {}  # open elements of each tag

    def text(self, raw: str) -> None:
        top = self.open[-1]
        if top.tag == "head" and raw.strip():
            self.close_to(len(self.open) - 1)  # text ends the head
            top = self.open[-1]
        if not (top.shown and top.visible):
            return
        value = html.unescape(raw) if "&" in raw else raw
        if top.pre:
            top.sheet.lines(value.replace("\r\n", "\n").replace("\r", "\n"))
        else:
            top.sheet.flow(value)

    def find(self, tags, barriers) -> int:
        if not any(self.many.get(t) for t in tags):
            return 0
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                return k
            if self.open[k].tag in barriers:
                return 0
        return 0

    def start(self, tag: str, attrs: str) -> None:
        if self.open[-1].tag == "head" and tag not in HEAD and tag != "head":
            self.close_to(len(self.open) - 1)
        if tag in CLOSES_P and (k := self.find(("p",), CELLS | {"table", "button"})):
            self.close_to(k)
        if tag in IMPLIED and (k := self.find(*IMPLIED[tag])):
            self.close_to(k)
        top = self.open[-1]
        given = {}
        if attrs and not attrs.isspace():
            for name, a, b, c in _ATTR.findall(attrs):
                given.setdefault(name.lower(), a or b or c)
        told = self.rules.told(tag, given) if "style" in given or self.rules.by else {}
        unshown = "hidden" in given or (tag == "dialog" and "open" not in given)
        shown = top.shown and tag not in HIDDEN and (told["display"] != "none" if "display" in told else not unshown)
        visible = top.visible if told.get("visibility", "inherit") == "inherit" else told["visibility"] not in ("hidden", "collapse")
        if tag in VOID:
            if shown and visible and tag == "br":
                top.sheet.need, top.sheet.space = (top.sheet.need + 1 if top.sheet.out else 0), False
            elif shown and tag == "hr":
                top.sheet.block(2)
            return
        frame = Frame(tag, shown, visible, top.sheet, top.table, top.pre or tag in ("pre", "textarea", "xmp"), top.sheet.indent)
        self.open.append(frame)
        self.many[tag] = self.many.get(tag, 0) + 1
        if not shown:
            return
        if tag == "table":
            frame.table = Table()
        elif tag in ("td", "th") and frame.table:
            frame.sheet = Sheet()
            frame.span = number(given.get("colspan"), 1000) or 1, number(given.get("rowspan"), 65534, 65534)
        elif tag == "tr" and frame.table:
            frame.table.row()
            return
        elif tag in BLOCK:
            frame.sheet.block(2 if tag in SPACED and not (tag in ("ul", "ol", "menu") and self.find(("li",), ("table",))) else 1)
        if tag == "ol":
            first = given.get("start") or "1"
            frame.number = int(first) if re.fullmatch(r"-?[0-9]{1,9}", first) else 1
        elif tag == "li":
            k = self.find(("ul", "ol", "menu"), ("table",))
            marker = "- "
            if k and self.open[k].number is not None:
                marker = f"{self.open[k].number}. "
                self.open[k].number += 1
            frame.marker = frame.sheet.marker  # of an item around this one that has no text yet: both stand on one line
            frame.sheet.marker = (frame.marker or frame.indent) + marker if visible else frame.marker
            frame.sheet.indent = frame.indent + " " * len(marker)

    def close_to(self, k: int) -> None:
        """Closes the open elements from the innermost to number ``k``."""
        while len(self.open) > k:
            frame = self.open.pop()
            self.many[frame.tag] -= 1
            if not frame.shown:
                continue
            if frame.tag == "table":
                rendered = frame.table.render()
                frame.sheet.block(2)
                if rendered:
                    frame.sheet.lines(rendered)
                frame.sheet.block(2)
            elif frame.tag in ("td", "th") and frame.table:
                frame.table.cell(frame.sheet.text(), *frame.span)
            elif frame.tag == "li":
                frame.sheet.marker, frame.sheet.indent = frame.marker if frame.sheet.marker else "", frame.indent
                frame.sheet.block(1)
            elif frame.tag in BLOCK and not (frame.tag == "tr" and frame.table):
                frame.sheet.block(2 if frame.tag in SPACED and not (frame.tag in ("ul", "ol", "menu") and self.find(("li",), ("table",))) else 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", "")
        if tag == "p" and not self.find(("p",), CELLS | {"table"}):
            return self.start("p", "")
        barriers = ("table",) if tag not in BLOCK | CELLS else ()
        if tag != "table" and tag not in BLOCK | CELLS:
            barriers = (*barriers, "td", "th")
        elif tag != "table":
            barriers = ("table",)
        if k := self.find((tag,), barriers):
            self.close_to(k)


def number(value: str | None, most: int, zero: int = 1) -> int:
    """A span: 1 if it is none, ``zero`` for 0."""
    if value is None or not (value.strip().isascii() and value.strip().isdigit()):
        return 1
    return min(int(value.strip()[:9]), most) or zero


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """(text | start | end | raw, tag, text or attributes) in order; raw: what a script or the like holds."""
    at, n = 0, len(source)
    while at < n:
        found = _TAG.search(source, at)
        if found is None:
            yield "text", "", source[at:]
            return
        if found.start() > at:
            yield "text", "", source[at : found.start()]
        at = found.end()
        if tag := found["start"] or found["odd"]:
            tag = tag.lower()
            yield "start", tag, found["attrs"] if found["start"] else found["rest"]
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                end = stop.start() if stop else n
                yield "raw", tag, source[at:end]
                at = end
        elif found["end"]:
            yield "end", found["end"].lower(), ""


def rules_of(source: str) -> Rules:
    rules = Rules()
    if re.search(r"<style\b", source, re.I):
        screen = True
        for kind, tag, text in tokens(source):
            if tag == "style" and kind == "start":
                media = [a or b or c for name, a, b, c in _ATTR.findall(text) if name.lower() == "media"]
                screen = not media or not media[0].strip() or bool(re.search(r"\b(?:screen|all)\b", media[0], re.I))
            elif tag == "style" and kind == "raw" and screen:
                rules.read(text)
    return rules


def render(source: str | None) -> str:
    """The visible text of a page."""
    if not source:
        return ""
    page = Page(rules_of(source))
    for kind, tag, text in tokens(source):
        if kind == "start":
            page.start(tag, text)
        elif kind == "end":
            page.end(tag)
        else:
            page.text(text)
    page.close_to(1)
    return page.sheet.text()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row a page: page_id, text, n_chars, n_lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part, sources in text_parts(batch):
                texts = list(map(render, sources))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                    ["page_id", "text", "n_chars", "n_lines"],
                )

    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, text string, n_chars long, n_lines long")
