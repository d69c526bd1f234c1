"""Main text of article pages: boilerplate elements go, text blocks stay."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import excerpt

#: Elements that hold no content, names of boilerplate, roles, and wrappers that are content after all.
DROPPED = {"script", "style", "noscript", "svg", "form", "iframe", "button", "nav", "header", "footer", "aside", "select", "option", "input"}
BOILERPLATE = re.compile(
    r"nav(bar)?|header|footer|sidebar|advert(isement)?|banner|cookie(-banner|-notice|-modal)?|share(-buttons|-widget|-bar)?|social(-media|-share|-icons)?|comment(s|-section|-form)?|"
    r"related(-articles|-posts|-content)?|newsletter(-signup|-form)?|author(-bio|-card)?|byline|popup|modal|overlay|promo|sponsor|taboola|outbrain|disqus|breadcrumb",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary"}
WRAPPERS = ("article-body", "post-content", "entry-content")
CONTAINER = re.compile(r"article[-_]?(body|content)|entry[-_]?content|post[-_]?content|story[-_]?content", re.IGNORECASE)
BLOCKS = {"h1", "h2", "h3", "h4", "p", "li", "blockquote"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "link", "meta", "param", "source", "track", "wbr", "input"}
ENDS_P = {"p", "div", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "article", "section", "main", "table", "pre", "footer", "header", "nav", "aside", "form", "hr"}
LEAST = 25
#: Pages whose texts leave a task at once.
SLICE = 128


class _Reader(HTMLParser):
    """One pass: texts of blocks by the container they stand in, in the order of their start."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, str, list | None]] = []  # tag, dropped, container kind, block
        self.blocks: list[tuple[str, list[str]]] = []
        self.plain: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    del self.stack[i:]
                    break
                if self.stack[i][0] in ENDS_P:
                    break
        if tag == "li":
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in ("ul", "ol"):
                    break
                if self.stack[i][0] == "li":
                    del self.stack[i:]
                    break
        known = {k: v or "" for k, v in attrs}
        names, own = known.get("class", ""), known.get("id", "")
        dropped = bool(self.stack and self.stack[-1][1]) or tag in DROPPED or known.get("role", "") in ROLES
        if (BOILERPLATE.search(names) or BOILERPLATE.search(own)) and not any(w in f"{names} {own}".lower() for w in WRAPPERS):
            dropped = True
        kind = self.stack[-1][2] if self.stack else ""
        if tag in ("article", "main"):
            kind = "main"
        elif tag == "div" and kind != "main" and CONTAINER.search(names):
            kind = "div"
        elif tag == "body" and not kind:
            kind = "body"
        block = None
        if tag in BLOCKS and not dropped:
            block = []
            self.blocks.append((kind, block))
        if tag not in VOID:
            self.stack.append((tag, dropped, kind, block))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        data = data.strip()
        if not data or self.stack and self.stack[-1][1]:
            return
        self.plain.append((self.stack[-1][2] if self.stack else "", data))
        for _, _, _, block in self.stack:
            if block is not None:
                block.append(data)


def main_text(page: str | None) -> str:
    """The text blocks of the main container, joined by empty lines."""
    if not page or not page.strip():
        return ""
    reader = _Reader()
    reader.feed(page)
    reader.close()
    kinds = {k for k, _ in reader.plain} | {k for k, _ in reader.blocks}
    target = next((k for k in ("main", "div", "body", "") if k in kinds), "")
    inside = {"main": {"main"}, "div": {"div"}, "body": {"body", "div", "main"}, "": kinds}[target]
    good = lambda t: len(t) > LEAST and not BOILERPLATE.search(t[:60])
    texts = [" ".join(parts) for kind, parts in reader.blocks if kind in inside]
    texts = [t for t in texts if good(t)] or [t for kind, t in reader.plain if kind in inside and good(t)]
    kept = [t for i, t in enumerate(texts) if not i or texts[i - 1] != t]
    return re.sub(r"\n{3,}", "\n\n", "\n\n".join(kept)).strip()


def article_text(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, full_text and excerpt of every page."""
    kind = pages.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one page at a time leaves the batch and its texts go on in slices, so a worker holds no second copy of it
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = pa.array((main_text(page.as_py()) for page in part.column(1)), pa.string(), size=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), texts], [key, "full_text"])

    texts = pages.select(key, html).mapInArrow(run, f"{key} {kind}, full_text string")
    return texts.withColumn("excerpt", excerpt(F.col("full_text")))
