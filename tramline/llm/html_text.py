"""The visible text of web pages, laid out in lines.

Method: a tree builder reads the page tag by tag, closes what HTML closes by
implication (paragraphs, list items, table rows and cells, the head) and drops
what never shows (scripts, styles, comments, elements that are hidden by
attribute or style). A renderer walks the tree and writes lines: blocks start
lines, paragraph-like blocks stand apart by a blank line, list items carry
their mark and depth, preformatted text keeps its spaces, and the cells of a
table are padded to the width of their column.

Trees are walked without recursion, so nesting has no limit but memory. A
column wider than ``ALIGN_WIDTH`` is not padded, so that one long cell does not
widen every row. Rows of pages are independent: one pass, nothing is shuffled.

Defined results: a NULL or empty page has empty text and no title. Ids may be
NULL or repeat; each row has its own result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALIGN_WIDTH = 60
PAGE_SCHEMA = "page_id long, title string, text string, n_chars long"


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Kinds of elements in HTML.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title xmp iframe noembed noframes noscript")
NEVER_SHOWN = _names(
    "head script style template title meta link base noscript iframe noembed noframes object audio video canvas datalist"
)
HEAD_ONLY = _names("base link meta title style script noscript template")
APART = _names("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table pre hr figure fieldset menu")
BLOCKS = APART | _names(
    "html body address article aside center details dialog dd div dt figcaption footer form header legend li main nav "
    "optgroup option search section summary caption thead tbody tfoot tr td th"
)
CLOSES_P = BLOCKS - _names("html body optgroup option caption thead tbody tfoot tr td th legend")
FORMATTING = _names("a b big code em font i nobr s small span strike strong sub sup tt u abbr cite q mark label")
# An opening tag closes these open elements, up to the nearest element that stands guard.
IMPLIED = {
    "li": (_names("li"), _names("ul ol menu table td th")),
    "dt": (_names("dt dd"), _names("dl table td th")),
    "dd": (_names("dt dd"), _names("dl table td th")),
    "option": (_names("option"), _names("select datalist optgroup")),
    "optgroup": (_names("option optgroup"), _names("select")),
    "tr": (_names("tr td th caption"), _names("table")),
    "td": (_names("td th caption"), _names("table tr")),
    "th": (_names("td th caption"), _names("table tr")),
    "thead": (_names("thead tbody tfoot tr td th caption"), _names("table")),
    "tbody": (_names("thead tbody tfoot tr td th caption"), _names("table")),
    "tfoot": (_names("thead tbody tfoot tr td th caption"), _names("table")),
}
GUARDS = _names("table td th caption html body")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
SPACE = re.compile(r"[ \t\n\f\r]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []

    def hidden(self) -> bool:
        has = self.attributes
        return (
            self.tag in NEVER_SHOWN
            or "hidden" in has
            or (self.tag == "dialog" and "open" not in has)
            or bool(HIDING.search(has.get("style", "")))
        )


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def _close(stack: list[Node], names: frozenset[str], guards: frozenset[str]) -> None:
    """Close the outermost open element of these names inside the nearest guard."""
    at = len(stack)
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in names:
            at = i
        elif stack[i].tag in guards:
            break
    del stack[at:]


def _end(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            if tag in FORMATTING and any(x.tag in BLOCKS for x in stack[i + 1 :]):
                del stack[i]  # the blocks inside stay open
            else:
                del stack[i:]
            return
        if stack[i].tag in GUARDS and tag not in BLOCKS:
            return
        if stack[i].tag == "table" and tag not in ("html", "body"):
            return


def build(page: str) -> Node:
    """The tree of a page; its root has no tag."""
    root = Node("", {})
    stack, at = [root], 0
    while at < len(page):
        found = TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            if text.strip():
                _close(stack, _names("head"), frozenset())
            stack[-1].children.append(unescape(text))
        if not found:
            break
        at = found.end()
        closing, opening, rest = found.group(1), found.group(2), found.group(3)
        if closing:
            tag = closing.lower()
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            else:
                _end(stack, tag)
        elif opening:
            tag = opening.lower()
            if tag not in HEAD_ONLY and tag not in ("html", "head"):
                _close(stack, _names("head"), frozenset())
            if tag in CLOSES_P:
                _close(stack, _names("p"), GUARDS)
            if tag in IMPLIED:
                _close(stack, *IMPLIED[tag])
            node = Node(tag, _attributes(rest) if len(rest) > 1 else {})
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                node.children.append(page[at : end.start() if end else len(page)])
                at = end.end() if end else len(page)
            elif tag not in VOID:
                stack.append(node)
    return root


class Flow:
    """Lines in the making."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.apart = False
        self.indent = ""
        self.mark = ""

    def text(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if not self.parts or self.parts[-1].endswith(" "):
            text = text.removeprefix(" ")
        if text:
            self.parts.append(text)

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts = []
        if line or always:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        for line in lines:
            if self.apart and self.lines:
                self.lines.append("")
            self.apart = False
            lead = self.indent[: len(self.indent) - len(self.mark)] + self.mark
            self.lines.append((lead + line).rstrip(" "))
            self.mark = ""

    def block(self, apart: bool) -> None:
        self.end_line()
        self.apart |= apart and bool(self.lines)


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table whose cells are (lines, columns, rows spanned)."""
    grid: list[list[list[str]]] = []
    below: dict[int, int] = {}  # rows that a cell above still takes, by column
    for row in rows:
        out: list[list[str]] = []

        def skip_taken() -> None:
            while below.get(len(out), 0):
                below[len(out)] -= 1
                out.append([])

        for lines, columns, deep in row:
            skip_taken()
            for k in range(columns):
                if deep > 1:
                    below[len(out)] = deep - 1
                out.append(lines if k == 0 else [])
        skip_taken()
        grid.append(out)
    width = [0] * max(map(len, grid), default=0)
    for row in grid:
        for k, cell in enumerate(row):
            width[k] = max([width[k], *(len(x) for x in cell if len(x) <= ALIGN_WIDTH)])
    out_lines = []
    for row in grid:
        for i in range(max((len(cell) for cell in row), default=0)):
            cells = [(cell[i] if i < len(cell) else "").ljust(width[k]) for k, cell in enumerate(row)]
            out_lines.append("  ".join(cells).rstrip(" "))
    return out_lines


def _span(node: Node, name: str) -> int:
    text = node.attributes.get(name, "1")
    return min(max(int(text), 1), 1000) if text.isascii() and text.isdigit() and len(text) < 6 else 1


def render(root: Node) -> str:
    """The lines of all visible text below ``root``."""
    flows = [Flow()]
    tables: list[list] = []  # rows of open tables
    lists: list[tuple[str, int]] = []  # kind and next number of open lists
    pre = 0
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if pre:
                first, *more = node.replace("\r\n", "\n").split("\n")
                flow.parts.append(first)
                for line in more:
                    flow.end_line(always=True)
                    flow.parts.append(line)
            else:
                flow.text(node)
            continue
        tag = node.tag
        if not leaving:
            if node.hidden():
                continue
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            if tag == "br":
                flow.end_line(always=True)
            elif tag in BLOCKS and tag not in ("td", "th"):
                nested_list = tag in ("ul", "ol", "menu") and bool(lists)
                flow.block(tag in APART and not nested_list)
            if tag == "pre":
                pre += 1
                if children and isinstance(children[0], str):
                    children = [children[0].removeprefix("\n"), *children[1:]]
            elif tag in ("ul", "ol", "menu"):
                start = node.attributes.get("start", "1")
                lists.append((tag, int(start) if re.fullmatch(r"-?[0-9]{1,6}", start) else 1))
            elif tag == "li":
                kind, number = lists[-1] if lists else ("ul", 1)
                mark = f"{number}. " if kind == "ol" else "- "
                if lists:
                    lists[-1] = (kind, number + 1)
                flow.indent += " " * len(mark)
                flow.mark = mark
                node.attributes = {"mark": mark}
            elif tag in ("blockquote", "dd"):
                flow.indent += "  "
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                flows.append(Flow())
            if tag not in VOID:
                todo.append((node, True))
                todo.extend((c, False) for c in reversed(children))
            continue
        if tag in ("td", "th") and tables:
            flow.end_line()
            flows.pop()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((flow.lines, _span(node, "colspan"), _span(node, "rowspan")))
            continue
        if tag in BLOCKS:
            nested_list = tag in ("ul", "ol", "menu") and len(lists) > 1
            flow.block(tag in APART and not nested_list and tag != "table")
        if tag == "pre":
            pre -= 1
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            flow.indent = flow.indent[: len(flow.indent) - len(node.attributes["mark"])]
            flow.mark = ""
        elif tag in ("blockquote", "dd"):
            flow.indent = flow.indent[:-2]
        elif tag == "table":
            flow.add(aligned(tables.pop()))
            flow.block(True)
    flows[0].end_line()
    return "\n".join(flows[0].lines).strip("\n")


def title(root: Node) -> str | None:
    """The text of the first title element."""
    todo: list[Node | str] = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            if node.tag == "title":
                return SPACE.sub(" ", unescape("".join(c for c in node.children if isinstance(c, str)))).strip(" ")
            todo.extend(reversed(node.children))
    return None


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        titles, texts = [], []
        for page in batch.column("html"):  # one tree at a time
            tree = build(page.as_py() or "")
            titles.append(title(tree))
            texts.append(render(tree))
        yield pa.record_batch(
            [
                batch.column("page_id"),
                pa.array(titles, pa.string()),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            names=["page_id", "title", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, title, text, n_chars`` of each row of ``pages(page_id, html)``."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("html").cast("string"))
    return pages.mapInArrow(_extract, PAGE_SCHEMA)
