"""HTML extraction by layout-aware rendering.

A page becomes a tree: end tags that HTML lets authors leave out are implied,
and elements that are never shown are cut out (head, scripts, styles, templates,
``noscript``, the fallbacks of frames, objects, audio, video and canvas, data lists,
definitions and descriptions in ``svg``, annotations in ``math``,
``hidden`` attributes, ``display:none``, ``visibility:hidden``): they are opened and
closed like all others, but hang on no parent.  The tree is rendered as text: blocks start new
lines, paragraphs and headings stand between blank lines, list items have
bullets or numbers and are indented by their depth, preformatted text keeps
its blanks, and table cells are padded to the width of their column; a cell
over several columns or rows (``colspan``, ``rowspan``) moves the others as on a page.

Attributes are read as HTML reads them: a quote opens a value only right after
the ``=``, an unquoted value ends at a blank or ``>``, and any other quote is
a character like others, so a stray one hides no text.

The tree is kept on explicit stacks, so that deeply nested pages need no
recursion.  Pages are independent of each other: one input row, one output
row.  A page is read in one piece inside its task, whatever its length: memory grows with the
longest page of a batch, time with its length.

Defined results: null and empty pages give an empty text and a null title;
repeated rows give repeated rows; broken markup is read as far as it goes (an
unclosed tag ends the page, a stray end tag is ignored); null ids are kept;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from servicelens.llm.text import keyed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template noscript iframe object datalist noembed noframes audio video canvas".split())
# What a head may hold (anything else ends it), and what is not shown inside svg and math.
HEAD_CONTENT = set("base basefont bgsound head html link meta title script style template noscript noframes".split())
FOREIGN = {"svg", "math"}
FOREIGN_UNSEEN = set(
    "annotation annotation-xml clippath defs desc lineargradient marker mask metadata pattern radialgradient symbol title".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = SPACED | set(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup"
    " html legend li main menu nav option search section summary tbody tfoot thead tr".split()
)
# An opening tag closes an open element of the second column, up to the third.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = {"table", "td", "th", "caption", "object", "template", "html", "body"}

# Attributes as the HTML tokenizer reads them.
BLANK = r"[ \t\n\r\f]"
ATTRIBUTE = (
    r"(?P<name>[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)"
    rf"(?:{BLANK}*+={BLANK}*+(?:\"(?P<double>[^\"]*+)(?:\"|\Z)|'(?P<single>[^']*+)(?:'|\Z)|(?P<bare>[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+))?+)?+"
)
ATTRIBUTES = re.compile(ATTRIBUTE + r"|(?P<slash>[ \t\n\r\f/]++)")
_ANY = rf"(?:[ \t\n\r\f/]++|{re.sub('[?]P<[a-z]+>', '?:', ATTRIBUTE)})*+"
TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
    rf"|/(?P<end>[a-zA-Z][^ \t\n\r\f/>]*+){_ANY}(?:>|\Z)"
    rf"|(?P<start>[a-zA-Z][^ \t\n\r\f/>]*+)(?P<attributes>{_ANY})(?:>|\Z))",
    re.DOTALL,
)
# Declarations that hide an element, and the most rows and columns of a cell.
HIDING = {"display": {"none"}, "visibility": {"hidden", "collapse"}}
MOST_COLUMNS, MOST_ROWS = 1000, 65534
COLUMN_GAP = "  "


def read_attributes(text: str) -> tuple[dict[str, str], bool]:
    """Values by lower-case name (the first of a name counts), and whether the tag closes itself."""
    found, closed = {}, False
    for m in ATTRIBUTES.finditer(text):
        closed = bool(m["slash"]) and m["slash"].endswith("/")
        if m["name"]:
            value = m["double"] or m["single"] or m["bare"] or ""
            found.setdefault(m["name"].lower(), html.unescape(value) if "&" in value else value)
    return found, closed


def hidden(attributes: dict[str, str]) -> bool:
    """The element is not shown, by its own attributes."""
    if "hidden" in attributes:
        return True
    last = {}
    for declaration in attributes.get("style", "").lower().split(";"):
        name, _, value = declaration.partition(":")
        last[name.strip()] = value.partition("!")[0].strip()
    return any(last.get(name) in values for name, values in HIDING.items())


def number(text: str | None, default: int = 1) -> int:
    """A leading whole number of up to nine digits."""
    m = re.match(r"\s*([-+]?[0-9]{1,9})", text or "")
    return int(m[1]) if m else default


class Node:
    __slots__ = ("name", "children", "start", "columns", "rows")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.children, self.start, self.columns, self.rows = name, [], 1, 1, 1
        if attributes and name == "ol":
            self.start = number(attributes.get("start"))
        elif attributes and name in ("td", "th"):
            self.columns = min(max(number(attributes.get("colspan")), 1), MOST_COLUMNS)
            rows = number(attributes.get("rowspan"))  # 0: all further rows
            self.rows = min(rows, MOST_ROWS) if rows > 0 else MOST_ROWS if rows == 0 else 1


def tree(page: str) -> tuple[Node, str | None]:
    """The tree of shown elements, and the title."""
    root, title = Node("html"), None
    stack, foreign, at = [root], 0, 0  # foreign: open svg and math elements

    def leave(k: int) -> None:
        nonlocal foreign
        foreign -= sum(n.name in FOREIGN for n in stack[k:])
        del stack[k:]

    def close(names: set[str], borders: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                leave(k)
                return close(names, borders)
            if stack[k].name in borders:
                return None
        return None

    while at < len(page):
        m = TAG.search(page, at)
        if upto := page[at : m.start() if m else len(page)]:
            if stack[-1].name == "head" and upto.strip(" \t\n\r\f"):
                leave(len(stack) - 1)
            stack[-1].children.append(html.unescape(upto))
        if not m:
            break
        at = m.end()
        if m["start"]:
            name = m["start"].lower()
            attributes, closed = read_attributes(m["attributes"])
            if stack[-1].name == "head" and name not in HEAD_CONTENT:
                leave(len(stack) - 1)
            if name == "plaintext" and not foreign:  # no markup after it
                close({"p"}, SCOPE)
                if not hidden(attributes):
                    stack[-1].children.append(Node("pre"))
                    stack[-1].children[-1].children.append(page[at:])
                break
            if name in RAW and not (foreign and (closed or name == "title")):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                inside, at = page[at : end.start() if end else len(page)], end.end() if end else len(page)
                if name == "title" and title is None:
                    title = " ".join(html.unescape(inside).split())
                if name == "textarea":
                    stack[-1].children.append(html.unescape(inside))
                elif name == "xmp" and not hidden(attributes):
                    close({"p"}, SCOPE)
                    stack[-1].children.append(Node("pre"))
                    stack[-1].children[-1].children.append(inside)
                continue
            if name in IMPLIED_ENDS:
                close(*IMPLIED_ENDS[name])
            if name in BLOCK and name != "option":  # a block ends an open paragraph
                close({"p"}, SCOPE)
            if name in ("html", "body"):
                continue
            unseen = (name in UNSEEN or foreign and name in FOREIGN_UNSEEN or hidden(attributes)) and name not in VOID
            # every text of a drawing stands on its own
            node = Node("div" if foreign and name == "text" else name, attributes)
            if not unseen:
                stack[-1].children.append(node)
            if name not in VOID and not (foreign and closed):
                stack.append(node)
                foreign += name in FOREIGN
        elif m["end"]:
            name = m["end"].lower()
            if foreign and name == "text":
                name = "div"
            if name == "p" and not any(n.name == "p" for n in stack):
                stack[-1].children.append(Node("p"))
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    leave(k)
                    break
                if stack[k].name == "template":
                    break  # nor out of a template
                if name not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot") and stack[k].name in ("td", "th", "table"):
                    break  # an end tag does not reach out of its cell
    return root, title


class Lines:
    """Text under construction: lines of a width-free page."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank waits for the next word
        self.gap = False  # an empty line waits for the next text
        self.lead = ""  # what the next line begins with
        self.indent = 0

    def words(self, text: str) -> None:
        for k, word in enumerate(re.split(r"[ \t\n\r\f]+", text)):
            if k:
                self.blank = True
            if word:
                self._open()
                if self.blank and len(self.line) > 1:
                    self.line.append(" ")
                self.blank = False
                self.line.append(word)

    def _open(self) -> None:
        if not self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            lead = self.lead or "  " * self.indent
            self.line, self.lead, self.blank = [lead], "", False

    def end(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        self.line, self.blank = [], False

    def put(self, text: str) -> None:
        """A line as it is."""
        self._open()
        self.line.append(text)
        self.end()

    def preformatted(self, text: str) -> None:
        first, *rest = text.split("\n")
        if first:
            self._open()
            self.line.append(first)
        for line in rest:
            self._open()
            self.lines.append("".join(self.line).rstrip())
            self.line = []
            if line:
                self._open()
                self.line.append(line)

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def rendered(root: Node) -> str:
    """The text of a tree.  The stack holds (node, what to do with it); a table
    renders its cells into lines of their own and then lays them out."""
    out = Lines()
    outs = [out]
    tables: list[list] = []  # rows of (text, columns, rows); None where a group of rows begins
    lists: list[list] = []  # (kind, next number)
    pre = 0
    todo: list[tuple[object, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        out = outs[-1]
        if isinstance(node, str):
            out.preformatted(node) if pre else out.words(node)
            continue
        name = node.name
        if leaving:
            if name in ("td", "th"):
                if len(outs) > 1:
                    outs.pop()
                    tables[-1][-1].append((out.text(), node.columns, node.rows))
                continue
            if name in BLOCK:
                out.end()
            if name in SPACED:
                out.gap = True
            if name == "pre":
                pre -= 1
            elif name in ("ul", "ol"):
                lists.pop()
                out.indent -= 1
                out.gap = not lists
            elif name == "blockquote":
                out.indent -= 1
            elif name == "table":
                for line in laid_out(tables.pop()):
                    out.put(line)
                out.gap = True
            continue
        if name == "br":
            if out.line:
                out.end()
            else:
                out.gap = True
            continue
        if name in ("td", "th") and tables:
            if not tables[-1] or tables[-1][-1] is None:
                tables[-1].append([])
            outs.append(Lines())
        elif name in BLOCK:
            out.end()
            if name in SPACED and not (name in ("ul", "ol") and lists):
                out.gap = True
            if name == "pre":
                pre += 1
            elif name in ("ul", "ol"):
                lists.append([name, node.start])
                out.indent += 1
            elif name == "blockquote":
                out.indent += 1
            elif name == "li":
                mark = "* "
                if lists and lists[-1][0] == "ol":
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.lead = "  " * max(0, out.indent - 1) + mark
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("tbody", "thead", "tfoot") and tables:
                tables[-1].append(None)
        todo.append((node, True))
        todo.extend((child, False) for child in reversed(node.children))
    return outs[0].text()


def placed(rows: list) -> list[list[tuple[int, int, list[str]]]]:
    """(first column, column after the last, lines) of every cell, by row."""
    grid, over = [], []  # over: (first column, column after, rows left) of cells from rows above
    for row in rows:
        if row is None:
            over = []
            continue
        at, taken, cells, below = 0, 0, [], []
        for text, columns, height in row:
            while taken < len(over) and over[taken][0] <= at:
                at = max(at, over[taken][1])
                taken += 1
            cells.append((at, at + columns, text.split("\n")))
            if height > 1:
                below.append((at, at + columns, height - 1))
            at += columns
        over = sorted([(a, b, left - 1) for a, b, left in over if left > 1] + below)
        grid.append(cells)
    return grid


def laid_out(rows: list) -> Iterator[str]:
    """The lines of a table: columns as wide as their widest cell.  Only columns
    in which some cell begins take room."""
    grid = placed(rows)
    begins = sorted({a for row in grid for a, _, _ in row})
    cells = [[(bisect_left(begins, a), bisect_left(begins, b), lines) for a, b, lines in row] for row in grid]
    widths = [0] * len(begins)
    wide = []
    for row in cells:
        for a, b, lines in row:
            longest = max(map(len, lines))
            if b - a == 1:
                widths[a] = max(widths[a], longest)
            else:
                wide.append((a, b, longest))
    for a, b, longest in wide:  # the last column makes room
        widths[b - 1] += max(0, longest - sum(widths[a:b]) - len(COLUMN_GAP) * (b - a - 1))
    offsets = [w + k * len(COLUMN_GAP) for k, w in enumerate(accumulate(widths, initial=0))]
    for row in cells:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            parts, length = [], 0
            for a, _, lines in row:
                if k < len(lines) and lines[k]:
                    room = offsets[a] - length  # cells may overlap
                    blanks = " " * room if room > 0 else COLUMN_GAP if length else ""
                    parts += blanks, lines[k]
                    length += len(blanks) + len(lines[k])
            if text := "".join(parts).rstrip():
                yield text


def extracted(page: str) -> tuple[str | None, str]:
    root, title = tree(page)
    return title, rendered(root)


def extractor():
    """Batches of (__id, __text) -> __id, title, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extracted(page.as_py()) for page in batch.column("__text")]
            columns = [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *columns], ["__id", "title", "text"])

    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: id, title, text."""
    rows = keyed(pages, id_col, html_col).select("__id", "__text")
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(extractor(), f"__id {kind}, title string, text string").withColumnRenamed("__id", id_col)


def op1_query(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
