"""Dates in text and HTML. All results are UTC wall-clock timestamps; `now` is always a parameter."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted forms (what a date must look like, and its pattern), tried in this order.
ZONE = r"([+-]\d{2}:?\d{2}|Z)"
FORMS = [
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}T\d{{1,2}}:\d{{2}}:\d{{2}}{ZONE}$", "y-M-d'T'H:m:s[XXX][XX]"),
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}T\d{{1,2}}:\d{{2}}:\d{{2}}\.\d{{1,6}}{ZONE}$", "y-M-d'T'H:m:s.[SSSSSS][SSSSS][SSSS][SSS][SS][S][XXX][XX]"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$", "y-M-d'T'H:m:s"),
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}} \d{{1,2}}:\d{{2}}:\d{{2}}{ZONE}$", "y-M-d H:m:s[XXX][XX]"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$", "y-M-d H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$", "d MMM y H:m:s XX"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2} (?:GMT|UTC|Z)$", "d MMM y H:m:s z"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "y/M/d H:m:s"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"),
]
#: JSON-LD fields and meta tags by priority.
LD_FIELDS = ["datePublished", "dateCreated", "dateModified", "uploadDate"]
META_TAGS = [
    (r"""<meta\s+property=["']article:published_time["']\s+content=["']([^"']+)["']""", "og:article:published_time"),
    (r"""<meta\s+content=["']([^"']+)["']\s+property=["']article:published_time["']""", "og:article:published_time"),
    (r"""<meta\s+property=["']og:published_time["']\s+content=["']([^"']+)["']""", "og:published_time"),
    (r"""<meta\s+property=["']og:updated_time["']\s+content=["']([^"']+)["']""", "og:updated_time"),
    (r"""<meta\s+name=["']publish[_-]?date["']\s+content=["']([^"']+)["']""", "meta:publish_date"),
    (r"""<meta\s+name=["']pubdate["']\s+content=["']([^"']+)["']""", "meta:pubdate"),
    (r"""<meta\s+name=["']date["']\s+content=["']([^"']+)["']""", "meta:date"),
    (r"""<meta\s+name=["']parsely-pub-date["']\s+content=["']([^"']+)["']""", "meta:parsely-pub-date"),
    (r"""<meta\s+name=["']sailthru.date["']\s+content=["']([^"']+)["']""", "meta:sailthru.date"),
]
#: Seconds of a unit in relative dates.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_utc(text: Column) -> Column:
    """Timestamp of a date in one of the FORMS, without a zone taken as UTC; else null. The session's time zone must be UTC."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"(?<=\d)Z$", "+00:00")
    return let(clean, lambda c: F.coalesce(*[F.when(c.rlike(look), F.try_to_timestamp(c, F.lit(form))) for look, form in FORMS]).cast("timestamp_ntz"))


def dated(when: Column, label: Column) -> Column:
    return let(when, lambda at: F.when(at.isNotNull(), F.struct(at.alias("at"), label.alias("label"))))


def first_dated(candidates: Column) -> Column:
    """(at, label) of the first of an array of (text, label) that parses."""
    parsed = F.transform(candidates, lambda c: F.struct(parse_utc(c["text"]).alias("at"), c["label"].alias("label")))
    return F.get(F.filter(parsed, lambda x: x["at"].isNotNull()), F.lit(0))


def candidate(text: Column, label: str) -> Column:
    return F.struct(text.alias("text"), F.lit(label).alias("label"))


NONE = "ARRAY<STRUCT<text: STRING, label: STRING>>"


def ld_candidates(html: Column) -> Column:
    """The dates in JSON-LD blocks: of each block the root or its items, then their @graph nodes, by LD_FIELDS."""
    blocks = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    fields = ", ".join(f"{f}: STRING" for f in LD_FIELDS)
    quoted = f"STRUCT<{fields}>"
    node = quoted[:-1] + f", `@graph`: ARRAY<{quoted}>>"
    items = F.transform(blocks, lambda b: F.when(F.trim(b).startswith("["), F.from_json(b, F.lit(f"ARRAY<{node}>"))).otherwise(F.array(F.from_json(b, F.lit(node)))))
    plain = lambda x: F.struct(*[x[f].alias(f) for f in LD_FIELDS])
    nodes = F.flatten(F.transform(F.flatten(items), lambda x: F.concat(F.array(plain(x)), F.coalesce(x["@graph"], F.array().cast(f"ARRAY<{quoted}>")))))
    found = F.flatten(F.transform(F.filter(nodes, lambda x: x.isNotNull()), lambda x: F.array(*[candidate(x[f], f"json_ld:{f}") for f in LD_FIELDS])))
    return F.coalesce(F.filter(found, lambda c: c["text"].isNotNull()), F.array().cast(NONE))


def meta_candidates(html: Column) -> Column:
    found = F.array(*[candidate(F.regexp_extract(html, "(?i)" + pattern, 1), label) for pattern, label in META_TAGS])
    return F.when(html.rlike("(?i)<meta"), F.filter(found, lambda c: c["text"] != "")).otherwise(F.array().cast(NONE))


def time_candidates(html: Column) -> Column:
    texts = F.regexp_extract_all(html, F.lit(r"""(?i)<time[^>]*datetime=["']([^"']+)["'][^>]*>"""), F.lit(1))
    return F.transform(texts, lambda x: candidate(x, "html5:time_element"))


def json_ld(html: Column) -> Column:
    return first_dated(ld_candidates(html))


def meta_tag(html: Column) -> Column:
    return first_dated(meta_candidates(html))


def time_tag(html: Column) -> Column:
    return first_dated(time_candidates(html))


def relative(text: Column, now: Column) -> Column:
    """Dates such as "2 hours ago"; "just now" comes first and "yesterday" next, wherever they stand."""
    pattern = r"\b(\d+)\s*(second|minute|hour|day|week|month|year)s?\s*ago\b"
    back = lambda s: (now - F.make_dt_interval(secs=s)).cast("timestamp_ntz")

    def counted(found: Column) -> Column:
        n, unit = found["n"].try_cast("bigint"), found["unit"]
        seconds = reduce(lambda c, x: c.when(unit == x[0], n * x[1]), UNIT_SECONDS.items(), F.when(F.lit(False), F.lit(0).cast("bigint")))
        return dated(back(seconds), F.concat(F.lit("relative_text:"), n.cast("string"), F.lit("_"), unit, F.lit("s_ago")))

    def read(low: Column) -> Column:
        parts = F.struct(F.regexp_extract(low, pattern, 1).alias("n"), F.regexp_extract(low, pattern, 2).alias("unit"))
        named = lambda at, name: F.struct(at.cast("timestamp_ntz").alias("at"), F.lit(f"relative_text:{name}").alias("label"))
        return F.when(low.rlike("just now|moments ago"), named(now, "just_now")).when(low.contains("yesterday"), named(back(F.lit(86400)), "yesterday")).when(low.contains("ago"), let(parts, counted))

    return let(F.trim(F.lower(text)), read)


def waterfall(html: Column, feed: Column, last_modified: Column, now: Column) -> Column:
    """(at, label) of the first source with a date: JSON-LD, meta tags, time tags, relative text, feed, header. Null rejects.
    A source is read only if those before it have no date."""

    def read(r: Column) -> Column:
        page = r["page"]
        tags = [json_ld(page), meta_tag(page), time_tag(page), relative(F.regexp_replace(page, r"(?s)<[^>]*>", " "), now)]
        return F.coalesce(*tags, dated(parse_utc(r["feed"]), F.lit("feed_metadata")), dated(parse_utc(r["modified"]), F.lit("http_header:last_modified")))

    return let(F.struct(F.coalesce(html, F.lit("")).alias("page"), feed.alias("feed"), last_modified.alias("modified")), read)


def age_hours(at: Column, now: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(now) - micros(at)) / 3.6e9


def is_fresh(at: Column, now: Column, hours: float = 24.0) -> Column:
    """Whether the age is between nothing and the limit; dates in the future and no date are not fresh."""
    return F.coalesce(age_hours(at, now).between(0, hours), F.lit(False))
