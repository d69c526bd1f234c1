"""Layout-aware text of HTML pages.

A tolerant tree builder reads tags in any order: end tags that HTML lets authors omit are implied (p, li, dt, dd,
tr, td, th, option and the like), stray end tags are ignored, and script and style are raw text. A renderer then walks the
tree, at any depth, and writes what a reader would see:
nothing of the head, of scripts and styles, or of elements hidden by the attribute hidden or by inline style; runs of white
space as one space outside of pre; blocks on lines of their own, with an empty line around paragraphs, headings, lists and
tables; list items with their marks, indented by depth; table cells in columns of equal width, where lines of more than
WIDEST are wrapped between words unless nothing follows them in their row.

Each page is rendered where it is read, so nothing is shuffled. Null pages give null, pages without visible text
an empty text. Repeated rows are rendered each; extra columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Width at which the lines of a cell are wrapped. A longer word widens its column.
WIDEST = 60

#: Element names by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title iframe noembed noframes noscript datalist object svg math canvas audio video select input textarea meta link base param source track".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr menu".split())
BLOCKS = SPACED | frozenset("html body address article aside center dd details dialog div dt fieldset figcaption footer form header hgroup legend li main nav option search section summary tr td th caption thead tbody tfoot".split())
#: Start tags that end an open p, and for each element the open ones that its start tag ends, up to a container.
ENDS_P = BLOCKS - frozenset("td th tr caption thead tbody tfoot option body html".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: Elements that an unmatched inner end tag does not reach beyond.
WALLS = frozenset({"table", "td", "th", "caption", "html", "template"})

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!\s*important\s*)?(?:;|$)", re.IGNORECASE)
NUMBER = re.compile(r"\s*([+-]?\d{1,9})")
SPACES = re.compile(r"[ \t\n\r\f]+")


def attributes(source: str) -> dict[str, str]:
    """The attributes of a start tag; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        # most tags have no attributes
        self.tag, self.attrs, self.children = tag, attributes(attrs) if attrs else {}, []


def parse(source: str) -> Node:
    """The tree of a page; text nodes are strings with their entities resolved."""
    root = Node("html")
    stack = Stack(root)
    at, end = 0, len(source)

    def text(part: str) -> None:
        if part:
            stack[-1].children.append(html.unescape(part) if "&" in part else part)

    while at < end:
        m = TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            _close(stack, tag)
            continue
        if tag == "html":
            continue
        attrs = m.group(3)
        _imply(stack, tag)
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID or (attrs.endswith("/") and tag not in BLOCKS and tag not in RAW):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            stop = close.start() if close else end
            node.children.append(source[at:stop] if tag in ("script", "style") else html.unescape(source[at:stop]))
            at = close.end() if close else end
        else:
            stack.append(node)
    return root


class Stack(list):
    """The open elements, with how many there are of each name, so that no search for an absent one goes through all."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.count = Counter()

    def append(self, node: Node) -> None:
        super().append(node)
        self.count[node.tag] += 1

    def cut(self, k: int) -> None:
        """Close the elements from the k-th on."""
        for node in self[k:]:
            self.count[node.tag] -= 1
        del self[k:]


def _imply(stack: Stack, tag: str) -> None:
    """End what the start tag ends, and open the rows and bodies that it needs."""
    if tag in ENDS_P and stack.count["p"]:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                stack.cut(k)
                break
            if stack[k].tag in WALLS or stack[k].tag in BLOCKS:
                break
    if tag in ENDS and any(stack.count[x] for x in ENDS[tag][0]):
        ends, until = ENDS[tag]
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in until:
                break
            if stack[k].tag in ends:
                stack.cut(k)
                if tag not in ("tr", "thead", "tbody", "tfoot"):
                    break
                return _imply(stack, tag)
    if stack[-1].tag == "head" and tag in BLOCKS:
        stack.cut(len(stack) - 1)
    if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
        row = Node("tr")
        stack[-1].children.append(row)
        stack.append(row)
    return None


def _close(stack: Stack, tag: str) -> None:
    for k in range(len(stack) - 1, 0, -1) if stack.count[tag] else ():
        if stack[k].tag == tag:
            stack.cut(k)
            return
        if stack[k].tag in WALLS and tag not in WALLS | {"tr", "thead", "tbody", "tfoot", "body"}:
            return
    if tag == "p":
        stack[-1].children.append(Node("p"))


class Writer:
    """Lines of text; gaps between blocks are remembered until more text comes."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.gap, self.space = "", 0, False
        self.marks: list[str] = []  # what the next line begins with

    def inline(self, text: str) -> None:
        if not text:
            return
        flat = SPACES.sub(" ", text)
        if flat[0] == " ":
            self.space = True
            flat = flat[1:]
        if not flat:
            return
        trailing = flat[-1] == " "
        self._put((" " if self.space and self.line else "") + (flat[:-1] if trailing else flat))
        self.space = trailing

    def _put(self, text: str) -> None:
        if not self.line and self.gap and self.lines:
            self.lines += [""] * (self.gap - 1)
        self.gap = 0
        self.line += text

    def exact(self, text: str) -> None:
        parts = text.replace("\r\n", "\n").split("\n")
        for i, part in enumerate(parts):
            if part:
                self._put(part)
            if i < len(parts) - 1:
                self.feed()
        self.space = False

    def feed(self) -> None:
        """Ends the line, even an empty one."""
        if not self.line and self.gap and self.lines:
            self.lines += [""] * (self.gap - 1)
            self.gap = 0
        self.lines.append(self.line)
        self.line, self.space = "", False

    def block(self, gap: int) -> None:
        """Ends the line if there is one; at least gap line ends stand before what follows."""
        if self.line:
            self.lines.append(self.line)
            self.line = ""
        self.space = False
        self.gap = max(self.gap, gap)

    def result(self) -> list[str]:
        self.block(1)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def seen(node: Node) -> bool:
    own = node.attrs
    return node.tag not in UNSEEN and not (own and ("hidden" in own or ("style" in own and HIDING.search(own["style"]))))


def width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text) if not text.isascii() else len(text)


def wrapped(text: str) -> list[str]:
    """A line as lines of at most WIDEST, broken between words only."""
    if width(text) <= WIDEST:
        return [text]
    lines, line, used = [], "", 0
    for word in text.split(" "):
        w = width(word)
        if line and used + 1 + w > WIDEST:
            lines.append(line)
            line, used = word, w
        else:
            line, used = (f"{line} {word}", used + 1 + w) if line else (word, w)
    return [*lines, line]


#: The walkers below are generators that yield the walks they need done first; `run_walk` keeps them on a list, so no depth
#: of a page exhausts the interpreter's stack.
Walk = Iterator["Walk"]


def run_walk(walk: Walk) -> None:
    waiting = [walk]
    while waiting:
        inner = next(waiting[-1], None)
        if inner is None:
            waiting.pop()
        else:
            waiting.append(inner)


def _walk(node: Node, out: Writer, pre: bool) -> Walk:
    for child in node.children:
        if isinstance(child, str):
            out.exact(child) if pre else out.inline(child)
        elif not seen(child):
            continue
        elif child.tag == "br":
            out.feed()
        elif child.tag == "hr":
            out.block(2)
            out._put("---")
            out.block(2)
        elif child.tag in ("ul", "ol", "menu"):
            yield _list(child, out)
        elif child.tag == "table":
            yield _table(child, out)
        elif child.tag in BLOCKS:
            gap = 2 if child.tag in SPACED else 1
            out.block(gap)
            if child.tag == "blockquote":
                yield _indented(child, out, "> ", "> ")
            elif child.tag == "dd":
                yield _indented(child, out, "    ", "    ")
            else:
                yield _walk(child, out, pre or child.tag == "pre")
            out.block(gap)
        else:
            yield _walk(child, out, pre)


def _indented(node: Node, out: Writer, first: str, others: str) -> Walk:
    inner = Writer()
    yield _walk(node, inner, False)
    for i, line in enumerate(inner.result() or ([""] if first.strip() not in ("", ">") else [])):
        out._put(((first if i == 0 else others) + line).rstrip())
        out.feed()


def _number(node: Node, name: str, otherwise: int) -> int:
    found = NUMBER.match(node.attrs.get(name, ""))
    return int(found.group(1)) if found else otherwise


def _list(node: Node, out: Writer) -> Walk:
    out.block(2)
    number = _number(node, "start", 1)
    loose = Node("li")
    for child in [*node.children, None]:
        item = isinstance(child, Node) and child.tag == "li"
        if child is not None and not item:
            loose.children.append(child)
            continue
        if any(not isinstance(c, str) or c.strip() for c in loose.children):
            yield _indented(loose, out, "  ", "  ")
        loose = Node("li")
        if item and seen(child):
            if node.tag == "ol":
                number = _number(child, "value", number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            yield _indented(child, out, mark, " " * len(mark))
    out.block(2)


def _rows(node: Node, found: list[tuple[str, list[Node]]]) -> None:
    for child in node.children:
        if isinstance(child, str) or not seen(child):
            if isinstance(child, str) and child.strip():
                found.append(("text", [child]))
        elif child.tag == "tr":
            found.append(("row", [c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and seen(c)]))
            loose = [c for c in child.children if not (isinstance(c, Node) and c.tag in ("td", "th"))]
            if any(not isinstance(c, str) or c.strip() for c in loose):
                found.append(("text", loose))
        elif child.tag in ("thead", "tbody", "tfoot"):
            _rows(child, found)
        else:
            found.append(("text", [child]))


def _table(node: Node, out: Writer) -> Walk:
    out.block(2)
    found: list[tuple[str, list[Node]]] = []
    _rows(node, found)
    rows = []
    for kind, cells in found:
        if kind == "text":
            holder = Node("div")
            holder.children = cells
            cells = [holder]
        lines = []
        for i, cell in enumerate(cells):
            inner = Writer()
            yield _walk(cell, inner, False)
            own = inner.result()
            lines.append([part for line in own for part in wrapped(line)] if i < len(cells) - 1 else own)
        rows.append((kind, lines))
    columns: dict[int, int] = {}
    for kind, cells in rows:
        if kind == "row":
            for i, lines in enumerate(cells[:-1]):  # nothing follows the last one
                columns[i] = max([columns.get(i, 0), *map(width, lines)])
    for kind, cells in rows:
        for k in range(max(map(len, cells), default=0)):
            parts = [lines[k] if k < len(lines) else "" for lines in cells]
            if kind == "row":
                parts = [p + " " * (columns[i] - width(p)) if i < len(cells) - 1 else p for i, p in enumerate(parts)]
            line = "  ".join(parts).rstrip()
            if line:
                out._put(line)
                out.feed()
    out.block(2)


def render(source: str | None) -> str | None:
    """The visible text of a page."""
    if source is None:
        return None
    out = Writer()
    run_walk(_walk(parse(source.replace("\x00", "")), out, False))
    return "\n".join(line.rstrip() for line in out.result()).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of pages: id_col and text."""
    kind = pages.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = pa.array([render(x.as_py()) for x in part.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), texts], names=[id_col, "text"])

    return pages.select(id_col, F.col(html_col).cast("string").alias("_h")).mapInArrow(run, f"{id_col} {kind}, text string")
