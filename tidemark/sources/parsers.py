"""Parsers of landed payloads (JSON, Atom and RSS, Markdown, paper cards) as DataFrame expressions.

Each takes a DataFrame with one payload per row and returns records; broken payloads give no records."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import classify, dates, text

#: The line form of a product, and of links.
PRODUCT_LINE = r"^[-*]\s+\[([^\]]+)\]\((https?://[^\)]+)\)(?:\s*[-–—:]\s*(.*))?"
LINK = r"\[([^\]]+)\]\((https?://[^\)]+)\)"
JOBS = "struct<jobs:array<struct<title:string,first_published:string,updated_at:string,absolute_url:string,location:struct<name:string>>>>"
LEVER = "array<struct<text:string,createdAt:bigint,hostedUrl:string,applyUrl:string,categories:struct<location:string>>>"
REMOTE = "array<struct<legal:string,company:string,position:string,tags:array<string>,date:string,url:string,location:string>>"
PAPERS = "array<struct<title:string,publishedAt:string,paper:struct<id:string,title:string,authors:array<string>,publishedAt:string,summary:string>>>"
MODELS = "array<struct<id:string,modelId:string>>"
SPACES = "array<struct<id:string,_id:string,tags:array<string>>>"


def lines(docs: DataFrame, payload: str) -> DataFrame:
    """A row per line of each payload, with line_no, and the section of the last heading above."""
    heading = F.when(F.col("line").rlike("^##{1,2} "), F.lower(F.trim(F.ltrim(F.col("line"), F.lit("# ")))))
    order = Window.partitionBy("_row").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return _lines(docs, payload).withColumn("heading", heading).withColumn("section", F.last("heading", ignorenulls=True).over(order)).drop("_row")


def _lines(docs: DataFrame, payload: str) -> DataFrame:
    """A row per line, with _row: payloads with equal other columns are not mixed up."""
    keys = [c for c in docs.columns if c != payload]
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    return rows.select(*keys, "_row", F.posexplode(F.split(payload, r"\R")).alias("line_no", "line")).withColumn("line", F.trim("line"))


def _in_section(rows: DataFrame, default: str) -> DataFrame:
    section = F.coalesce("section", F.lit(default))
    return rows.withColumn("section", section).where(F.col("heading").isNull() & ~section.rlike(classify.any_of(classify.IGNORED_SECTIONS)))


def markdown_products(docs: DataFrame, payload: str) -> DataFrame:
    """Product lines outside of ignored sections: name, link, description, parent company and price."""
    rows = _in_section(lines(docs, payload), "")
    part = lambda i: F.trim(F.regexp_extract("line", PRODUCT_LINE, i))
    rows = rows.where(F.col("line").rlike(PRODUCT_LINE)).withColumns({"name": part(1), "link": part(2), "description": part(3)})
    rows = rows.where(classify.good_name(F.col("name"), classify.NO_PRODUCT_NAMES))
    company = classify.maker(F.col("description"), text.netloc(F.col("link")))
    return rows.withColumns({"company": company, "pricing": classify.pricing(F.concat_ws(" ", "name", "description"))}).drop("line", "heading")


def markdown_startups(docs: DataFrame, payload: str) -> DataFrame:
    """Links outside of ignored sections to hosts that may be startups; the first link of each host stays."""
    keys = [c for c in docs.columns if c != payload]
    rows = _in_section(lines(docs, payload), "general")
    links = F.arrays_zip(F.regexp_extract_all("line", F.lit(LINK), F.lit(1)).alias("n"), F.regexp_extract_all("line", F.lit(LINK), F.lit(2)).alias("l"))
    rows = rows.select(*keys, "section", "line_no", F.posexplode(links).alias("pos", "z"))
    rows = rows.withColumns({"name": F.trim("z.n"), "link": F.col("z.l")}).withColumn("host", text.netloc(F.col("link")))
    rows = rows.where(classify.good_name(F.col("name"), classify.NO_STARTUP_NAMES) & classify.startup_host(F.col("host")))
    first = F.row_number().over(Window.partitionBy(*keys, "host").orderBy("line_no", "pos")) == 1
    return rows.withColumn("first", first).where("first").drop("first", "z")


def heading_links(docs: DataFrame, payload: str) -> DataFrame:
    """A title per "### " heading with the first pricing link below it, before the next heading."""
    keys = [c for c in docs.columns if c != payload]
    rows = _lines(docs, payload)
    title = F.when(F.col("line").startswith("### "), F.trim(F.substring("line", 5, 10_000)))
    order = Window.partitionBy("_row").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("title", title).withColumn("block", F.count("title").over(order)).withColumn("name", F.last("title", ignorenulls=True).over(order))
    rows = rows.where(F.col("title").isNull() & F.col("line").contains("[More Information and Pricing](")).withColumn("link", F.regexp_extract("line", r"\((https?://[^\)]+)\)", 1))
    first = rows.where("block > 0").groupBy(*keys, "_row", "block").agg(F.min_by("link", "line_no").alias("link"), F.min_by("name", "line_no").alias("name"), F.min("line_no").alias("line_no"))
    return first.where((F.col("link") != "") & F.length("name").between(2, 60)).drop("block", "_row")


def _items(docs: DataFrame, payload: str, schema: str, path: str = "") -> DataFrame:
    parsed = F.from_json(payload, F.lit(schema))
    return docs.select(*[c for c in docs.columns if c != payload], F.posexplode(parsed[path] if path else parsed).alias("pos", "item"))


def _job(rows: DataFrame, at: Column, now: Column, source: Column | None = None) -> DataFrame:
    rows = rows.withColumn("published", at)
    if source is not None:
        rows = rows.withColumn("date_source", source)
    return rows.where(dates.is_fresh(F.col("published"), now)).withColumn("age_hours", F.round(dates.age_hours(F.col("published"), now), 2))


def greenhouse_jobs(docs: DataFrame, payload: str, now: Column) -> DataFrame:
    """Fresh jobs; the date is first_published, else updated_at."""
    rows = _items(docs, payload, JOBS, "jobs").where(F.coalesce("item.absolute_url", F.lit("")) != "")
    first, updated = dates.parse_utc(F.col("item.first_published")), dates.parse_utc(F.col("item.updated_at"))
    rows = _job(rows, F.coalesce(first, updated), now, F.when(first.isNotNull(), "first_published").otherwise("updated_at"))
    about = F.concat_ws(" ", F.coalesce("item.location.name", F.lit("")), F.coalesce("item.title", F.lit("")))
    return rows.select(*[c for c in rows.columns if c != "item"], F.col("item.absolute_url").alias("url"), F.col("item.title").alias("title"), classify.is_remote(about).alias("is_remote"), classify.role_family(F.coalesce("item.title", F.lit(""))).alias("role_family"))


def lever_jobs(docs: DataFrame, payload: str, now: Column) -> DataFrame:
    """Fresh postings, dated by epoch milliseconds."""
    rows = _items(docs, payload, LEVER).withColumn("url", text.first_filled(F.col("item.hostedUrl"), F.col("item.applyUrl"))).where("url IS NOT NULL")
    rows = _job(rows, F.timestamp_millis("item.createdAt").cast("timestamp_ntz"), now)
    about = F.concat_ws(" ", F.coalesce("item.categories.location", F.lit("")), F.coalesce("item.text", F.lit("")))
    return rows.select(*[c for c in rows.columns if c != "item"], F.col("item.text").alias("title"), classify.is_remote(about).alias("is_remote"), classify.role_family(F.coalesce("item.text", F.lit(""))).alias("role_family"))


def remote_jobs(docs: DataFrame, payload: str, now: Column) -> DataFrame:
    """Fresh remote jobs; the first row is skipped if it is the legal note."""
    rows = _items(docs, payload, REMOTE).where("NOT (pos = 0 AND item.legal IS NOT NULL)").where(F.coalesce("item.url", F.lit("")) != "")
    rows = _job(rows, dates.parse_utc(F.col("item.date")), now)
    about = F.concat_ws(" ", F.coalesce("item.position", F.lit("")), F.array_join(F.coalesce("item.tags", F.array().cast("array<string>")), " "))
    return rows.select(*[c for c in rows.columns if c != "item"], F.col("item.url").alias("url"), F.coalesce("item.company", F.lit("Remote Company")).alias("company"), F.col("item.position").alias("title"), F.lit(True).alias("is_remote"), classify.role_family(about).alias("role_family"))


def daily_papers(docs: DataFrame, payload: str, most: int = 100) -> DataFrame:
    """Papers with an id: title, authors, address, repository, date."""
    rows = _items(docs, payload, PAPERS).where(F.col("pos") < most)
    title = text.first_filled(F.col("item.paper.title"), F.col("item.title"))
    # authors are strings or objects; an object arrives as its JSON text
    name = lambda a: F.trim(F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a))
    authors = F.filter(F.transform(F.coalesce("item.paper.authors", F.array().cast("array<string>")), name), lambda a: a.isNotNull() & (a != ""))
    repo = F.nullif(F.regexp_extract(F.coalesce("item.paper.summary", F.lit("")), r"https?://github\.com/([a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)", 0), F.lit(""))
    when = dates.parse_utc(text.first_filled(F.col("item.paper.publishedAt"), F.col("item.publishedAt")))
    rows = rows.where(title.isNotNull() & (F.coalesce("item.paper.id", F.lit("")) != ""))
    return rows.select(*[c for c in rows.columns if c != "item"], title.alias("title"), authors.alias("authors"), F.concat(F.lit("https://arxiv.org/abs/"), "item.paper.id").alias("paper_url"), repo.alias("github_url"), when.alias("published"))


def model_orgs(docs: DataFrame, payload: str) -> DataFrame:
    """Distinct organisations among model ids, the first of each."""
    keys = [c for c in docs.columns if c != payload]
    rows = _items(docs, payload, MODELS).withColumn("model", text.first_filled(F.col("item.id"), F.col("item.modelId"))).where(F.col("model").contains("/"))
    rows = rows.withColumn("slug", F.trim(F.split_part("model", F.lit("/"), F.lit(1)))).where(classify.is_org(F.col("slug")) & (F.length("slug") >= 2))
    return rows.groupBy(*keys, "slug").agg(F.min("pos").alias("pos")).withColumns({"name": text.display_name(F.col("slug")), "url": F.concat(F.lit("https://huggingface.co/"), "slug")})


def spaces(docs: DataFrame, payload: str, most: int = 200) -> DataFrame:
    """Apps with their account as candidate company, and FREE if a licence says so."""
    rows = _items(docs, payload, SPACES).where(F.col("pos") < most).withColumn("space", text.first_filled(F.col("item.id"), F.col("item._id"))).where("space IS NOT NULL")
    slug = F.when(F.col("space").contains("/"), F.trim(F.split_part("space", F.lit("/"), F.lit(1))))
    return rows.select(*[c for c in rows.columns if c not in ("item",)], text.display_name(slug).alias("company"), F.concat(F.lit("https://huggingface.co/spaces/"), "space").alias("url"), classify.license_pricing(F.col("item.tags")).alias("pricing"))


def atom_entries(docs: DataFrame, payload: str) -> DataFrame:
    """Entries of an Atom feed with a title, an id and a date: id, authors, repository."""
    keys = [c for c in docs.columns if c != payload]
    entries = F.regexp_extract_all(payload, F.lit(r"(?s)<entry[^>]*>(.*?)</entry>"), F.lit(1))
    rows = docs.select(*keys, F.posexplode(entries).alias("pos", "e"))
    one = lambda tag: F.nullif(F.trim(_plain(F.regexp_extract("e", rf"(?s)<(?:\w+:)?{tag}[^>]*>(.*?)</(?:\w+:)?{tag}>", 1))), F.lit(""))
    authors = F.transform(F.regexp_extract_all("e", F.lit(r"(?s)<author[^>]*>.*?<name[^>]*>(.*?)</name>"), F.lit(1)), lambda a: F.trim(_plain(a)))
    links = F.filter(F.regexp_extract_all("e", F.lit(r"""<link[^>]*href=["']([^"']*)["']"""), F.lit(1)), lambda x: x.contains("github.com"))
    rows = rows.withColumns({"title": text.collapse(one("title")), "id_url": one("id"), "published": dates.parse_utc(one("published"))})
    rows = rows.where("title IS NOT NULL AND id_url IS NOT NULL AND published IS NOT NULL")
    repo = F.coalesce(F.try_element_at(links, F.lit(1)), text.github_link(F.coalesce(one("summary"), F.lit("")), F.coalesce(one("comment"), F.lit(""))))
    return rows.select(*keys, "pos", "title", text.arxiv_id(F.col("id_url")).alias("arxiv_id"), authors.alias("authors"), repo.alias("github_url"), "published")


def feed_items(docs: DataFrame, payload: str) -> DataFrame:
    """Items of RSS or Atom feeds: link, title, date text, summary."""
    keys = [c for c in docs.columns if c != payload]
    items = F.regexp_extract_all(payload, F.lit(r"(?s)<(?:item|entry)\b[^>]*>(.*?)</(?:item|entry)>"), F.lit(1))
    rows = docs.select(*keys, F.posexplode(items).alias("pos", "e"))
    one = lambda tags: F.coalesce(*[F.nullif(F.trim(_plain(F.regexp_extract("e", rf"(?s)<{t}\b[^>]*>(.*?)</{t}>", 1))), F.lit("")) for t in tags])
    href = F.nullif(F.regexp_extract("e", r"""<link[^>]*href=["']([^"']*)["']""", 1), F.lit(""))
    return rows.select(*keys, "pos", F.coalesce(one(["link"]), href).alias("link"), one(["title"]).alias("title"), one(["pubDate", "published", "updated"]).alias("published"), one(["description", "summary"]).alias("summary")).where("link IS NOT NULL")


def _plain(value: Column) -> Column:
    """Character data without CDATA marks, the five entities resolved."""
    value = F.regexp_replace(value, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


class _Cards(HTMLParser):
    """Cards with the text of their first heading and their links."""

    def __init__(self, tag: str, pattern: str | None):
        super().__init__()
        self.tag, self.pattern = tag, pattern
        self.cards, self.open, self.heading = [], [], None

    def handle_starttag(self, tag, attrs):
        known = dict(attrs)
        if tag == self.tag:
            import re

            mine = self.pattern is None or re.search(self.pattern, known.get("class") or "")
            card = {"title": None, "links": []} if mine else None
            self.open.append(card)
            if card:
                self.cards.append(card)
        elif tag in ("h2", "h3") and self.heading is None:
            self.heading = ""
        elif tag == "a" and known.get("href"):
            for card in filter(None, self.open):
                card["links"].append(known["href"].strip())

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.open.pop()
        elif tag in ("h2", "h3") and self.heading is not None:
            for card in filter(None, self.open):
                if card["title"] is None:
                    card["title"] = self.heading.strip()
            self.heading = None

    def handle_data(self, data):
        if self.heading is not None:
            self.heading += data


def paper_cards(docs: DataFrame, key: str, payload: str) -> DataFrame:
    """key, pos, title, paper_url, github_url of the paper cards of HTML listings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, page in zip(batch[key], batch[payload], strict=True):
                cards = []
                for tag, pattern in (("div", r"paper-card|infinite-item|item"), ("article", None)):
                    parser = _Cards(tag, pattern)
                    parser.feed(page or "")
                    parser.close()
                    cards = parser.cards
                    if cards:
                        break
                for pos, card in enumerate(cards):
                    arxiv = [x for x in card["links"] if "arxiv.org/abs/" in x]
                    repos = [x for x in card["links"] if "arxiv.org/abs/" not in x and "github.com/" in x and not any(w in x.lower() for w in ("paperswithcode", "login", "signup"))]
                    pages = ["https://paperswithcode.com" + x for x in card["links"] if x.startswith("/papers/")]
                    url = (arxiv[-1:] or pages[-1:] or [None])[0]
                    if card["title"] and url:
                        out.append((k, pos, card["title"], url, repos[-1] if repos else None))
            yield pd.DataFrame(out, columns=[key, "pos", "title", "paper_url", "github_url"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, payload).mapInPandas(run, f"{key} {kind}, pos int, title string, paper_url string, github_url string")
