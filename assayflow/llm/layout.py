"""HTML to text by layout-aware rendering.

A builder keeps the stack of open elements, closes those whose end tags may be left out, and tells a renderer what
opens and closes. The renderer keeps a stack of areas (the page, and each open table cell) with lines of
text, and lays out blocks, lists, preformatted text and tables. It is iterative: deep nesting needs no recursion.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import append

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never shown; of svg, see DRAWN.
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes datalist object audio video canvas svg select".split())
#: Elements that an open head can hold; any other start tag, and text, ends it.
IN_HEAD = frozenset("title meta link base basefont bgsound style script noscript noframes template html head".split())
#: Elements whose text is shown inside svg, and those that are not shown inside svg or math.
DRAWN = frozenset("text foreignobject".split())
UNDRAWN = frozenset("defs symbol desc metadata clippath mask pattern marker annotation annotation-xml".split())
#: Elements set apart by a blank line, and those that only begin a new line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset".split())
BLOCKS = SPACED | frozenset("""html body div section article aside header footer nav main address form li dt dd hr figcaption details summary
    center legend menu dialog hgroup search caption tr td th thead tbody tfoot""".split())
#: An opening tag ends open elements of these names, searched up to an element of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    **{name: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}) for name in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, {"html"}),
}
#: Parts of a table; outside of one they are not elements.
PARTS = frozenset("tr td th thead tbody tfoot caption col colgroup".split())
#: Block elements that end an open paragraph.
ENDS_P = BLOCKS - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption"}
#: Elements that an end tag inside them does not reach past.
SCOPE = frozenset({"table", "td", "th", "html"})
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Area:
    """Lines of text being laid out: the page or one table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the current line
        self.gap = 0  # blank lines owed before the next line
        self.blank = True  # the current line ends in a blank, or is empty
        self.prefix = ""

    def write(self, text: str, pre: bool, indent: str) -> None:
        if pre:
            for number, line in enumerate(text.expandtabs(8).split("\n")):
                if number:
                    self.end_line(keep=True)
                if line:
                    self.put(line, indent)
            return
        text = BLANKS.sub(" ", text)
        if self.blank and text.startswith(" "):
            text = text[1:]
        if text:
            self.put(text, indent)
            self.blank = text.endswith(" ")

    def put(self, text: str, indent: str) -> None:
        if not self.parts:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            if self.prefix:
                indent, self.prefix = self.prefix, ""
            self.parts.append(indent)
        self.parts.append(text)
        self.blank = False

    def end_line(self, keep: bool = False) -> None:
        if self.parts or keep and self.lines:
            self.lines.append("".join(self.parts).rstrip())
        self.parts, self.blank = [], True

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced:
            self.gap = 1

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int]]] = []

    def lines(self) -> list[str]:
        """Cells side by side, columns as wide as their widest line; a cell that spans columns widens none."""
        wide: list[int] = []
        for row in self.rows:
            at = 0
            for lines, span in row:
                wide += [0] * (at + span - len(wide))
                if span == 1:
                    wide[at] = max([wide[at], *map(len, lines)])
                at += span
        result = []
        for row in self.rows:
            for level in range(max((len(lines) for lines, _ in row), default=0)):
                at, line = 0, []
                for lines, span in row:
                    room = sum(wide[at:at + span]) + 2 * (span - 1)
                    line.append((lines[level] if level < len(lines) else "").ljust(room))
                    at += span
                result.append("  ".join(line).rstrip())
        return result


class Renderer:
    """The open elements and what they put on the page."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []  # name, hidden (-1: shown inside svg)
        self.count: dict[str, int] = {}
        self.hidden = 0
        self.areas, self.tables, self.lists = [Area()], [], []

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "head" and self.in_head():
            return
        if name not in IN_HEAD and self.in_head():
            self.pop()
        if name in PARTS and not self.count.get("table"):
            return
        if self.count.get("p") and name in ENDS_P:
            self.end("p")
        if name in CLOSES:
            names, stop = CLOSES[name]
            if any(self.count.get(n) for n in names):
                self.close_upto(names, stop)
        if name == "br":
            if not self.hidden:
                self.areas[-1].end_line(keep=not self.areas[-1].parts)
            return
        if name == "img" and not self.hidden and attributes.get("alt"):
            self.areas[-1].write(attributes["alt"], False, self.indent())
        if name in VOID:
            if name == "hr" and not self.hidden:
                self.areas[-1].block(True)
            return
        hides = (name in UNSEEN or "hidden" in attributes and attributes["hidden"].lower() != "until-found"
                 or bool(HIDING.search(attributes.get("style", ""))) or name == "dialog" and "open" not in attributes
                 or name in UNDRAWN and self.foreign())
        if name in DRAWN and not hides and self.count.get("svg") and self.hidden == 1:  # nothing but svg hides it
            hides = -1
        self.open.append((name, hides))
        self.count[name] = self.count.get(name, 0) + 1
        self.hidden += hides
        if self.hidden:
            return
        area = self.areas[-1]
        if hides:
            area.block(False)
        if name == "table":
            area.block(True)
            self.tables.append(Table())
        elif name == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif name in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            span = attributes.get("colspan", "")
            self.tables[-1].rows[-1].append(([], min(max(int(span), 1), 1000) if span.isascii() and span.isdigit() else 1))
            self.areas.append(Area())
        elif name in BLOCKS:
            area.block(name in SPACED and not (self.lists and name in ("ul", "ol")))
            if name in ("ul", "ol", "menu"):
                first = attributes.get("start", "1")
                self.lists.append([name == "ol", int(first) if first.isascii() and first.lstrip("-").isdigit() else 1])
            elif name == "li":
                ordered, number = self.lists[-1] if self.lists else (False, 1)
                area.prefix = "  " * max(len(self.lists) - 1, 0) + (f"{number}. " if ordered else "- ")
                if self.lists:
                    self.lists[-1][1] += 1

    def end(self, name: str) -> None:
        if not self.count.get(name):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return

    def close_upto(self, names: set[str], stop: set[str]) -> None:
        depth = len(self.open)
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in stop:
                break
            if self.open[i][0] in names:
                depth = i
        while len(self.open) > depth:
            self.pop()

    def pop(self) -> None:
        name, hides = self.open.pop()
        self.count[name] -= 1
        shown = not self.hidden
        self.hidden -= hides
        if not shown:
            return
        if hides:
            self.areas[-1].block(False)
        if name in ("td", "th") and self.tables and len(self.areas) > 1:
            lines = self.areas.pop().done()
            row = self.tables[-1].rows[-1]
            row[-1] = (lines, row[-1][1])
        elif name == "table" and self.tables:
            area = self.areas[-1]
            for line in self.tables.pop().lines():
                area.put(line, self.indent())
                area.end_line()
            area.block(True)
        elif name in BLOCKS and name not in ("tr", "thead", "tbody", "tfoot"):
            if name in ("ul", "ol", "menu") and self.lists:
                self.lists.pop()
            self.areas[-1].block(name in SPACED and not (self.lists and name in ("ul", "ol")))
            self.areas[-1].prefix = ""

    def in_head(self) -> bool:
        return bool(self.open) and self.open[-1][0] == "head"

    def foreign(self) -> bool:
        return bool(self.count.get("svg") or self.count.get("math"))

    def indent(self) -> str:
        return "  " * len(self.lists) + "  " * self.count.get("blockquote", 0)

    def text(self, text: str) -> None:
        if self.in_head() and BLANKS.sub("", text):
            self.pop()
        if not self.hidden and text:
            inside_row = self.open and self.open[-1][0] in ("table", "tr", "thead", "tbody", "tfoot")
            if inside_row and not text.strip():
                return
            self.areas[-1].write(html.unescape(text), bool(self.count.get("pre")), self.indent())

    def finish(self) -> str:
        while self.open:
            self.pop()
        return "\n".join(self.areas[0].done())


def render(page: str) -> str:
    """All visible text of a page. Options of a select, which is a control, do not count as text."""
    out, at, end = Renderer(), 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            out.text(page[at:mark])
        if mark == end:
            break
        if page.startswith("<!--", mark):
            stop = page.find("-->", mark + 4)
            at = end if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            stop = page.find(">", mark)
            at = end if stop < 0 else stop + 1
            continue
        tag = TAG.match(page, mark)
        if tag is None:
            out.text("<")
            at = mark + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            if name == "br":
                out.start("br", {})
            elif name == "p" and not out.count.get("p"):
                out.start("p", {})
                out.end("p")
            else:
                out.end(name)
            continue
        attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(tag[3])} if tag[3] else {}
        out.start(name, attributes)
        if tag[3].endswith("/") and out.foreign():
            if out.open[-1][0] == name:
                out.pop()
            continue
        if name in RAW and not (name in VOID):
            close = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            stop = close.start() if close else end
            if name not in UNSEEN:
                out.text(page[at:stop])
            at = stop
            if not close:
                break
    return out.finish()


def extract(pages: DataFrame, source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Every row with ``text``, its visible text. Null and empty pages have empty text; repeated rows all come back.

    A column named ``text`` is replaced; all other columns pass unchanged. A null byte counts as a blank.
    """
    def step(batches):
        for batch in batches:
            yield [[render(page.decode("utf-8", "replace").replace("\0", " ")) for page in batch]]
    return append(pages, source, "text string", step, keep)
