import html
import random
import re
from collections import Counter
from html.parser import HTMLParser

import pytest

from tidemark.llm.htmltext import extract, render


@pytest.mark.parametrize(
    "source,expected",
    [
        ("", ""),
        ("plain &amp; simple  text", "plain & simple text"),
        ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>", "- x\n- y\n\n  - z\n- w"),
        ("<ol start=3><li>x</li><li value='7'>y</li><li>z</li></ol>", "3. x\n7. y\n8. z"),
        ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table>", "name       n\nlong name  1\nx          22"),
        ("<td>a<td>b", "a\nb"),
        ("<head><title>no</title></head><body>yes<script>if(a<b){'</p>'}</script><style>p{}</style>", "yes"),
        ("a<span hidden>b</span><div style='color:red; display: none'>c</div>e", "ae"),
        ('<p title="a hidden gem here">Hello</p>', "Hello"),
        ('<p class="a hidden b">c</p><p aria-hidden="true">d</p>', "c\n\nd"),
        ("<p HIDDEN>a</p><p hidden=until-found>b</p><p style=display:none>c</p><p style='DISPLAY : none !important'>d</p><p style='x-display:none'>e</p>", "e"),
        ("<p data-x='hidden' style=\"background:url('display:none')\">a</p>", "a"),
        ("<p style='color:red' style='display:none'>a</p><p style='visibility&#58;hidden'>b</p>", "a"),
        ("<pre>a  b\n  c</pre>d  e", "a  b\n  c\n\nd e"),
        ("a <b>bold</b>, <i> it</i>!", "a bold, it!"),
        ("<!-- x --><!DOCTYPE html>t<!-- unclosed", "t"),
        ("<blockquote>a<p>b</blockquote>c", "> a\n>\n> b\n\nc"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<script>never closed", ""),
        ("<h1>T</h1>x<hr>y", "T\n\nx\n\n---\n\ny"),
        ("</div></p>a</b>", "a"),
        ("<dl><dt>t<dd>d1<dt>u<dd>d2</dl>", "t\n    d1\nu\n    d2"),
    ],
)
def test_render(source, expected):
    assert render(source) == expected


def test_hidden_at_any_depth():
    assert render("<div>" * 5000 + "a<p style='display:none'>b</p><b hidden>c</b>d" + "</div>" * 5000 + "e") == "ad\ne"
    assert render("<span>" * 5000 + "<p>a</p>" + "</span>" * 5000 + "<i>b</i>") == "a\n\nb"
    deep = "<table><tr><td>" * 300 + "x" + "</table>" * 300
    assert render(deep) == "x"
    assert render("<div>" * 20_000 + "</b>" * 20_000 + "x") == "x"


def test_wide_cells_stay_aligned():
    long = " ".join(f"word{i}" for i in range(40))
    lines = render(f"<table><tr><td>{long}<td>end<tr><td>a<td>b<td>{long}</table>").split("\n")
    assert lines[0].endswith("end") and lines[-1].startswith("a ") and lines[0].index("end") == lines[-1].index("b")
    assert lines[-1].endswith(long) and max(map(len, lines[:-1])) <= 70
    assert " ".join(" ".join(lines[:-1]).replace("  end", " ").split()) == long
    assert render(f"<table><tr><td>{'y' * 300}<td>z<tr><td>a<td>b</table>") == f"{'y' * 300}  z\na{' ' * 301}b"


#: A second reading of small pages, by events: text between tags, with hidden elements counted open and closed.
class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "hr", "img"):
            return
        own = dict(reversed(attrs))
        gone = "hidden" in own or "display:none" in (own.get("style") or "").replace(" ", "")
        self.hidden.append((tag, gone))

    def handle_endtag(self, tag):
        assert self.hidden.pop()[0] == tag

    def handle_data(self, data):
        if not any(gone for _, gone in self.hidden):
            self.words += data.split()


@pytest.mark.parametrize("seed", range(60))
def test_visible_words_against_a_second_reader(seed):
    rng = random.Random(seed)
    tags = ["div", "section", "b", "i", "span", "blockquote", "pre", "ul", "table"]
    extra = ["", "", "", " hidden", ' style="display: none"', ' class="hidden"', " title='x hidden y'", ' aria-hidden="true"', " data-a=hidden"]
    count = [0]

    def page(depth):
        parts = []
        for _ in range(rng.randint(1, 4)):
            count[0] += 1
            parts.append(f" w{count[0]} &amp; ")
            if depth:
                tag, attrs = rng.choice(tags), rng.choice(extra)
                inner = page(depth - 1)
                inner = f"<li{rng.choice(extra)}>{inner}</li>" if tag == "ul" else f"<tr><td{rng.choice(extra)}>{inner}</td><td>x</td></tr>" if tag == "table" else inner
                parts.append(f"<{tag}{attrs}>{inner}</{tag}>")
        return "".join(parts)

    source = page(4)
    plain = Plain()
    plain.feed(source)
    plain.close()
    got = [w for w in render(source).replace("\n", " ").split() if w not in ("-", ">")]
    assert Counter(got) == Counter(plain.words)
    if "<table" not in source:
        assert got == plain.words


def test_deep_and_long():
    assert render("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert render("<ul><li>" * 300 + "x").strip().endswith("x")
    assert render("word " * 200_000) == ("word " * 200_000).strip()
    assert render("<a " * 20_000 + "x") is not None
    assert render(None) is None


def test_all_words_stay(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(pages).join(pages, "page_id").collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        words = html.unescape(re.sub("<[^>]*>", " ", body)).split()
        assert " ".join(words) in " ".join(r.text.split())
        assert "track(" not in r.text


def test_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, "y"), (2, "", "z")], "page_id long, html string, text string")
    assert sorted(((r.page_id or 0), r.text) for r in extract(pages).collect() if r.text is not None) == [(1, "a"), (1, "a"), (2, "")]
    assert extract(pages).count() == 4 and extract(pages.where("page_id > 5")).count() == 0
