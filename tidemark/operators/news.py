"""News records from article pages and the feed entries that led to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify, dates
from tidemark.operators import htmlclean, validate

#: Characters from which a page's own text counts as a body, and the title of an article without one.
LEAST_BODY, UNTITLED = 80, "Untitled AI Article"
#: Named entities of HTML that titles hold, the ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
Entities = list[tuple[str, str]]


def element_text(html: Column, tag: str, entities: Entities = ENTITIES) -> Column:
    """The text of the first element of that name, without tags; empty if there is none."""
    inner = F.regexp_replace(F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1), r"(?s)<[^>]*>", "")
    for name, sign in entities:
        inner = F.replace(inner, F.lit(name), F.lit(sign))
    return F.regexp_replace(inner, r"^\s+|\s+$", "")


def title_of(feed_title: Column, html: Column, entities: Entities = ENTITIES) -> Column:
    """The feed's title, else the first h1, else the page's title, else UNTITLED."""
    some = lambda x: dates.let(x, lambda t: F.when(t != "", t))
    return F.coalesce(some(feed_title), some(element_text(html, "h1", entities)), some(element_text(html, "title", entities)), F.lit(UNTITLED))


def body_of(full_text: Column, feed_summary: Column) -> Column:
    """The page's text if it is long enough, else the feed's summary, else whatever text there is; null if that is empty."""
    own = F.coalesce(full_text, F.lit(""))
    return dates.let(F.when(F.length(own) < LEAST_BODY, F.coalesce(feed_summary, own)).otherwise(own), lambda t: F.when(t != "", t))


def with_feed(pages: DataFrame, feed: DataFrame, seq: str = "seq") -> DataFrame:
    """pages (url, …) with feed_* columns of the first entry for their address, null without one."""
    names = [c for c in feed.columns if c not in ("url", seq)]
    first = feed.groupBy("url").agg(F.min_by(F.struct(*names), seq).alias("f")).select("url", *(F.col(f"f.{c}").alias(f"feed_{c}") for c in names))
    return pages.join(first, "url", "left")


def news_records(pages: DataFrame, feed: DataFrame, now: Column, hours: float = 24.0, entities: Entities = ENTITIES) -> DataFrame:
    """url, record (JSON), date_method, age_hours, excerpt, violations and status of pages (url, html, source_name, last_modified)
    that have a date, are fresh and have a body. feed: url, seq, source_name, title, published, summary.

    Text is extracted only from pages that the date lets through."""
    dated = with_feed(pages, feed).withColumn("_d", dates.waterfall(F.col("html"), F.col("feed_published"), F.col("last_modified"), now))
    fresh = dated.withColumn("age_hours", F.round(dates.age_hours(F.col("_d.at"), now), 2)).where(dates.is_fresh(F.col("_d.at"), now, hours))
    text = htmlclean.article_text(fresh.select("url", "html"), "url", "html").dropDuplicates(["url"])
    joined = fresh.join(text, "url").withColumn("_body", body_of(F.col("full_text"), F.col("feed_summary"))).where("_body IS NOT NULL").withColumn("_title", title_of(F.col("feed_title"), F.col("html"), entities))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    content = F.struct(F.col("_title").alias("title"), F.col("_body").alias("fullText"), iso(F.col("_d.at")).alias("publishedAt"), classify.mentions(F.concat_ws(" ", "_body", "_title")).alias("mentionedEntities"))
    source = F.struct(F.coalesce("feed_source_name", "source_name").alias("name"), F.col("url"))
    record = F.to_json(F.struct(F.lit("1.0").alias("schemaVersion"), F.lit("NEWS").alias("recordType"), source.alias("source"), content.alias("content"), iso(now).alias("collectedAt")))
    built = joined.select("url", record.alias("record"), F.col("_title").alias("title"), F.col("_d.at").alias("published"), F.col("_d.label").alias("date_method"), "age_hours", "excerpt")
    return validate.validate(built, "NEWS", "record")
