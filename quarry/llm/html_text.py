"""Visible text of web pages by layout-aware rendering (operator 7).

A page becomes a tree: start tags close what they imply closed (a paragraph before a block, an item
before the next item, cells and rows of a table), end tags close up to their match, raw elements take
their content whole.  The tree is walked with the rules of a plain style sheet: invisible elements
(head, scripts, ``hidden``, ``display:none`` ...) are skipped, visibility is inherited, white space
collapses outside ``pre``, blocks begin a line and paragraphs, headings and lists leave a blank one, list
items get markers and indents, table cells line up in columns, each with all its lines.  A table with a
cell of several blocks lays out the page: its cells follow one another.  Building and walking use explicit stacks and bounded depth,
so no page fails for its nesting.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import small_batches

#: Element classes of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = set("head script style template noscript title iframe noembed noframes object datalist audio video canvas "
             "link meta desc metadata defs symbol clippath annotation annotation-xml".split())
#: Raw elements in which character references count.
ESCAPED = {"textarea", "title"}
LISTS = set("ul ol menu dir".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure dl table".split()) | LISTS
BLOCKS = SPACED | set("html body div section article header footer nav aside main address center details summary dd dt li "
                      "fieldset form legend hr figcaption option optgroup tr caption search dialog hgroup".split())
#: Start tag -> open elements it closes, up to the given ancestors.
_cells, _rows = {"td", "th"}, {"tr"}
_groups = set("thead tbody tfoot caption colgroup".split())
IMPLIED = {"li": ({"li"}, LISTS), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
           "td": (_cells | {"caption"}, {"table", "tr"}), "th": (_cells | {"caption"}, {"table", "tr"}),
           "tr": (_cells | _rows | {"caption"}, {"table"})}
IMPLIED |= {g: (_cells | _rows | _groups, {"table"}) for g in _groups}
SCOPE = {"table", "td", "th", "caption", "button", "html", "body"}
ENDS_P = SCOPE | LISTS
THROUGH = set("table tr tbody thead tfoot td th html body".split())  # their end tags reach beyond a scope
#: HTML's bounds on spans; a wider colspan counts as 1.
ACROSS, DOWN = 1000, 65534

#: A quote opens a value only after =, and only if it is closed somewhere: then the value is taken whole.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)"""
                  r"""|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s/=][^\s/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s]*+)))?""")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_WHOLE = re.compile(r"\s*([+-]?\d{1,6})")
_SPACES = re.compile(r"[ \t\n\r\f\v]+")
#: Elements nested deeper than this become siblings, as in browsers.
DEEPEST = 512
#: Cells wider than this do not set their column's width.
WIDEST = 60
#: Columns that would begin further right are not aligned: two spaces stand between their cells.
FARTHEST = 1000


def attributes(raw: str) -> dict[str, str]:
    """Names and values of a start tag; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(raw):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def shown(style: str) -> tuple[str, str]:
    """Values of display and visibility; the last declaration of a property counts, important ones before others."""
    last: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub("", style).lower().split(";"):
        name, _, value = part.partition(":")
        value, mark, _ = value.partition("!")
        name = name.strip()
        if mark or not last.get(name, (False, ""))[0]:
            last[name] = bool(mark), value.strip()
    return last.get("display", (0, ""))[1], last.get("visibility", (0, ""))[1]


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attributes(attrs) if attrs else {}, []

    def visible(self, inherited: bool) -> bool | None:
        """None for an element without a box; else whether its own text shows."""
        display, visibility = shown(self.attrs["style"]) if "style" in self.attrs else ("", "")
        if display == "none" or ("hidden" in self.attrs and not display):
            return None
        if visibility in ("hidden", "collapse"):
            return False
        return inherited or visibility in ("visible", "initial")

    def number(self, name: str, default: int) -> int:
        found = _WHOLE.match(self.attrs.get(name, ""))
        return int(found[1]) if found else default


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("#root")
    stack, at = [root], 0
    opened: Counter[str] = Counter()  # open elements by name

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            opened[node.tag] -= 1
        del stack[depth:]

    def close(tags: set[str], until: set[str]) -> None:
        while any(opened[t] > 0 for t in tags):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in tags:
                    cut(depth)
                    break
                if stack[depth].tag in until:
                    return
            if not (tags & _cells or tags & _rows):
                return

    while at < len(page):
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else len(page)]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue  # comment, doctype, bogus
        if tag[1]:
            for depth in range(len(stack) - 1, 0, -1) if opened[name] > 0 else ():
                if stack[depth].tag == name:
                    cut(depth)
                    break
                if stack[depth].tag in SCOPE and name not in THROUGH:
                    if name == "p":
                        stack[-1].children.append(Node("p"))
                    break
            else:
                if name == "p":  # an end tag without its paragraph makes an empty one
                    stack[-1].children.append(Node("p"))
            continue
        if name in IMPLIED:
            close(*IMPLIED[name])
        if name in BLOCKS and name not in ("html", "body"):
            close({"p"}, ENDS_P)
        node = Node(name, tag[3])
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            text = page[at : end.start() if end else len(page)]
            node.children.append(html.unescape(text) if name in ESCAPED else text)
            at = end.end() if end else len(page)
        elif name not in VOID and not tag[3].endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
            opened[name] += 1
    return root


class Page:
    """Lines of rendered text."""

    def __init__(self):
        self.out: list[str] = []
        self.gap, self.blank, self.space = 0, True, False  # newlines due, line is empty, space due
        self.indents: list[str] = []
        self.between, self.blocks = False, False  # a block border is due, text has stood on both sides of one

    def line(self, gap: int = 1) -> None:
        if self.out:
            self.gap, self.between = max(self.gap, gap), True
        self.space = False

    def write(self, text: str) -> None:
        if self.gap:
            self.out.append("\n" * self.gap)
            self.gap, self.blank = 0, True
            self.blocks, self.between = self.blocks or self.between, False
        if self.blank:
            self.out.append("".join(self.indents))
            # a marker shows once; later lines of its item are indented by its width
            self.indents = [" " * len(i) for i in self.indents]
        elif self.space:
            self.out.append(" ")
        self.out.append(text)
        self.blank = self.space = False

    def flow(self, text: str) -> None:
        words = _SPACES.sub(" ", text)
        core = words.strip(" ")
        if words.startswith(" "):
            self.space = not self.blank and not self.gap
        if core:
            self.write(core)
            self.space = words.endswith(" ")

    def kept(self, text: str) -> None:
        for i, piece in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.gap = self.gap + 1 if self.out else 0
            if piece:
                self.write(piece)

    def text(self) -> str:
        return "".join(self.out)


def places(rows: list[list[tuple[str, bool, int, int]]]) -> list[list[tuple[int, str, int]]]:
    """(column, text, colspan) of the cells of each row, past the columns that cells from above still take."""
    out, taken = [], []  # taken: (first column, one past the last, first row free again), in order
    for r, row in enumerate(rows):
        taken = [t for t in taken if t[2] > r]
        line, new, at, k = [], [], 0, 0
        for text, _, across, down in row:
            across = across if 1 <= across <= ACROSS else 1
            while k < len(taken) and taken[k][0] <= at:
                at, k = max(at, taken[k][1]), k + 1
            line.append((at, text, across))
            if down != 1:
                until = r + (min(down, DOWN) if down > 0 else DOWN)  # 0: to the end
                if new and new[-1][1] == at and new[-1][2] == until:
                    new[-1] = new[-1][0], at + across, until
                else:
                    new.append((at, at + across, until))
            at += across
        if new:
            taken = sorted(taken + new)
        out.append(line)
    return out


def table_lines(rows: list[list[tuple[str, bool, int, int]]]) -> list[str]:
    """Rows of (text, whether of several blocks, colspan, rowspan) as lines with aligned columns; only columns
    in which a cell begins take room."""
    placed = places(rows)
    widths: dict[int, int] = {}
    for row in placed:
        for column, text, across in row:
            width = max(map(len, text.split("\n")))
            widths[column] = max(widths.get(column, 0), width if width <= WIDEST and across == 1 else 0)
    begins, at = {}, 0
    for column in sorted(widths):
        begins[column] = at if at <= FARTHEST else 0
        at += widths[column] + 2
    out = []
    for row in placed:
        cells = [(begins[column], text.split("\n")) for column, text, _ in row]
        for k in range(max((len(lines) for _, lines in cells), default=0)):
            line, size = [], 0
            for begin, lines in cells:
                if k < len(lines) and lines[k]:
                    pad = max(begin - size, 2 if size else 0)
                    line += [" " * pad, lines[k]]
                    size += pad + len(lines[k])
            out.append("".join(line).rstrip())
    return out


def render(page: str) -> str:
    """Visible text of a page."""
    out, pages, tables, lists, pre = Page(), [], [], [], 0
    todo: list[tuple[object, bool, bool]] = [(build(page), False, True)]
    while todo:
        node, leaving, visible = todo.pop()
        if isinstance(node, str):
            if visible:
                out.kept(node) if pre else out.flow(node)
            continue
        tag = node.tag
        if not leaving:
            if tag in UNSEEN or (tag == "dialog" and "open" not in node.attrs):
                continue
            if node.attrs and (visible := node.visible(visible)) is None:
                continue
            if tag == "br":
                out.gap, out.space = (out.gap + 1 if out.out else 0), False
                continue
            if tag == "table":
                out.line(2)
                tables.append([])
                pages.append(out)
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in _cells and tables:
                if not tables[-1]:
                    tables[-1].append([])
                pages.append(out)
                out = Page()
            elif tag in SPACED:
                # a list inside an item follows it without a blank line
                out.line(1 if tag in LISTS and lists else 2)
            elif tag in BLOCKS or tag == "text":  # a text of a drawing stands alone
                out.line()
            if tag in LISTS:
                lists.append(node.number("start", 1) if tag == "ol" else None)
                out.indents.append("")
            elif tag == "li":
                count = lists[-1] if lists else None
                if count is not None:
                    count = node.number("value", count)
                    lists[-1] = count + 1
                mark = "- " if count is None else f"{count}. "
                out.indents.append(mark if visible else " " * len(mark))
            elif tag in ("dd", "blockquote"):
                out.indents.append("  ")
            elif tag == "img":
                continue
            pre += tag in ("pre", "textarea", "xmp")
            todo.append((node, True, visible))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            if tag in ("mfrac", "mtr"):
                children = [x for c in children for x in (c, " ")]  # parts of a formula that do not stand side by side
            todo.extend((c, False, visible) for c in reversed(children))
            continue
        pre -= tag in ("pre", "textarea", "xmp")
        if tag in LISTS:
            lists.pop()
        if tag in LISTS or tag in ("li", "dd", "blockquote"):
            out.indents.pop()
        if tag in _cells and tables:
            text, blocks = out.text(), out.blocks
            out = pages.pop()
            tables[-1][-1].append((text if "\n" in text else text.strip(), blocks, node.number("colspan", 1), node.number("rowspan", 1)))
        elif tag == "table":
            out = pages.pop()
            rows = [r for r in tables.pop() if r]
            if any(blocks for row in rows for _, blocks, _, _ in row):
                for text in (cell[0] for row in rows for cell in row if cell[0]):
                    out.line(2 if "\n" in text else 1)
                    out.kept(text)
                    out.line(2 if "\n" in text else 1)
            else:
                for line in table_lines(rows):
                    out.line()
                    if line:
                        out.write(line)
            out.line(2)
        elif tag in SPACED:
            out.line(1 if tag in LISTS and lists else 2)
        elif tag in BLOCKS or tag == "text":
            out.line()
    return out.text()


def page_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text): the visible text of every whole page.

    A null or empty page has an empty text, and so has one with nothing visible.  One row per input
    row, repeated rows and null ids included; an empty table gives an empty result; other columns are
    not read.  Broken markup (unclosed tags, quotes or comments) never fails a page.  Very long pages are
    rendered whole; a table costs its real cells, however wide their spans.  Limits: elements nested deeper
    than ``DEEPEST`` become siblings; spans have HTML's bounds; columns beyond ``FARTHEST`` are not aligned.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [render(h.as_py() or "") for h in part["html"]]
                yield pa.RecordBatch.from_arrays([part["page_id"], pa.array(texts, pa.string())], ["page_id", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string")
