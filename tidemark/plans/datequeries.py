"""Dates in HTML and text, and freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.plans.registry import NOW, query
from tidemark.sources.readers import table


def now_col():
    return F.lit(NOW).cast("timestamp_ntz")

_D = "strftime(o_orderdate, '%Y-%m-%d')"

#: Date texts by key: ISO with zones, fractions, RFC 2822, slashes, plain dates, and no dates.
_TEXTS = [
    ("%Y-%m-%dT10:20:30+05:30", "yyyy-MM-dd'T10:20:30+05:30'", "+ INTERVAL '4 hours 50 minutes 30 seconds'"),
    ("%Y-%m-%dT10:20:30Z", "yyyy-MM-dd'T10:20:30Z'", "+ INTERVAL '10 hours 20 minutes 30 seconds'"),
    ("%Y-%m-%dT10:20:30.250-07:00", "yyyy-MM-dd'T10:20:30.250-07:00'", "+ INTERVAL '17 hours 20 minutes 30.25 seconds'"),
    ("%Y-%m-%d 01:02:03", "yyyy-MM-dd' 01:02:03'", "+ INTERVAL '1 hours 2 minutes 3 seconds'"),
    ("%Y-%m-%d", "yyyy-MM-dd", "+ INTERVAL '0 hours'"),
    ("%a, %d %b %Y 23:59:59 +0100", "EEE', 'dd MMM yyyy' 23:59:59 +0100'", "+ INTERVAL '22 hours 59 minutes 59 seconds'"),
    ("%a, %d %b %Y 05:00:00 GMT", "EEE', 'dd MMM yyyy' 05:00:00 GMT'", "+ INTERVAL '5 hours'"),
    ("%Y/%m/%d", "yyyy/MM/dd", "+ INTERVAL '0 hours'"),
    ("garbage", "'garbage'", None),
    ("", "''", None),
]
_CASES = " ".join(f"WHEN {i} THEN {'NULL' if add is None else f'date_trunc({chr(39)}day{chr(39)}, o_orderdate) {add}'}" for i, (_, _, add) in enumerate(_TEXTS))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.date_trunc("day", "o_orderdate").alias("day"))


def _text(i, day):
    out = F.when(F.lit(False), "")
    for k, (_, form, _) in enumerate(_TEXTS):
        out = out.when(i == k, F.lit("") if form == "''" else F.date_format(day, form))
    return out


@query("parse_dates", f"SELECT o_orderkey, CAST(CASE o_orderkey % 10 {_CASES} END AS TIMESTAMP) AS at FROM orders")
def parse_dates(spark, sf):
    return _orders(spark, sf).select("o_orderkey", dates.parse_utc(_text(F.col("o_orderkey") % 10, F.col("day"))).alias("at"))


def _day(form="yyyy-MM-dd"):
    return F.date_format("day", form)


@query(
    "json_ld_date",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN NULL ELSE CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS at,
    CASE o_orderkey % 5 WHEN 0 THEN 'json_ld:datePublished' WHEN 1 THEN 'json_ld:dateModified' WHEN 2 THEN 'json_ld:dateCreated' WHEN 3 THEN 'json_ld:uploadDate' END AS label FROM orders""",
)
def json_ld_date(spark, sf):
    i = F.col("o_orderkey") % 5
    block = lambda body: F.concat(F.lit('<html><script type="application/ld+json">'), body, F.lit("</script>"))
    page = (
        F.when(i == 0, block(F.concat(F.lit('{"@type":"News","dateModified":"1999-01-01","datePublished":"'), _day(), F.lit('"}'))))
        .when(i == 1, block(F.concat(F.lit('{"datePublished":"soon","@graph":[{"dateModified":"'), _day(), F.lit('"}]}'))))
        .when(i == 2, F.concat(block(F.lit("{broken")), block(F.concat(F.lit('[{"a":1},{"dateCreated":"'), _day(), F.lit('"}]')))))
        .when(i == 3, block(F.concat(F.lit('{"uploadDate":"'), _day(), F.lit('T00:00:00Z"}'))))
        .otherwise(F.lit("<html>no script"))
    )
    return _orders(spark, sf).select("o_orderkey", dates.json_ld(page).alias("d")).select("o_orderkey", "d.at", "d.label")


_META = ["article:published_time", "og:updated_time", "pubdate", "date", "parsely-pub-date", "none"]


@query(
    "meta_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS at,
    ['og:article:published_time', 'og:updated_time', 'meta:pubdate', 'meta:date', 'meta:parsely-pub-date', NULL][CAST(o_orderkey % 6 AS INT) + 1] AS label FROM orders""",
)
def meta_date(spark, sf):
    i = F.col("o_orderkey") % 6
    page = F.lit("<html>")
    for k, name in enumerate(_META):
        kind = "property" if ":" in name else "name"
        page = F.when(i == k, F.concat(F.lit(f'<meta name="date" content="soon"><META {kind}="{name}" content="' if name != "date" else '<meta name="date" content="'), _day(), F.lit('">'))).otherwise(page)
    return _orders(spark, sf).select("o_orderkey", dates.meta_tag(page).alias("d")).select("o_orderkey", "d.at", "d.label")


@query("time_tag_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS at FROM orders")
def time_tag_date(spark, sf):
    i = F.col("o_orderkey") % 3
    tag = F.concat(F.when(i == 1, "<time datetime='later'>x</time>").otherwise(""), F.when(i < 2, F.concat(F.lit('<time class="a" datetime="'), _day(), F.lit('">y</time>'))).otherwise("<time>z</time>"))
    return _orders(spark, sf).select("o_orderkey", dates.time_tag(tag)["at"].alias("at"))


_AGO = [("posted just now", None, "just_now"), ("Yesterday at noon", 86400, "yesterday"), ("3 hours ago", 10800, "3_hours_ago"), ("1 minute ago", 60, "1_minutes_ago"), ("about 2weeks ago", 1209600, "2_weeks_ago"), ("5 months ago", 12960000, "5_months_ago"), ("no date", -1, None)]


@query(
    "relative_date",
    f"""SELECT c_custkey, CASE c_custkey % 7 {' '.join(f'WHEN {i} THEN ' + ('{NOW}' if s is None else 'NULL' if s < 0 else '{NOW} - INTERVAL ' + str(s) + ' SECOND') for i, (_, s, _) in enumerate(_AGO))} END AS at,
    CASE c_custkey % 7 {' '.join(f"WHEN {i} THEN 'relative_text:{label}'" for i, (_, _, label) in enumerate(_AGO) if label)} END AS label FROM customer""",
)
def relative_date(spark, sf):
    words = F.element_at(F.array(*[F.lit(t) for t, _, _ in _AGO]), (F.col("c_custkey") % 7 + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", dates.relative(words, now_col()).alias("d")).select("c_custkey", "d.at", "d.label")


@query(
    "date_waterfall",
    """WITH w AS (SELECT o_orderkey, o_orderkey % 7 AS i, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS d FROM orders)
    SELECT o_orderkey, CASE WHEN i = 3 THEN {NOW} - INTERVAL 2 DAY WHEN i = 6 THEN NULL ELSE d END AS at,
    CASE i WHEN 0 THEN 'json_ld:datePublished' WHEN 1 THEN 'meta:date' WHEN 2 THEN 'html5:time_element' WHEN 3 THEN 'relative_text:2_days_ago' WHEN 4 THEN 'feed_metadata' WHEN 5 THEN 'http_header:last_modified' END AS label FROM w""",
)
def date_waterfall(spark, sf):
    i = F.col("o_orderkey") % 7
    ld = F.when(i == 0, F.concat(F.lit('<script type="application/ld+json">{"datePublished":"'), _day(), F.lit('"}</script>'))).otherwise("")
    meta = F.when(i == 1, F.concat(F.lit('<meta name="date" content="'), _day(), F.lit('">'))).when(i == 0, '<meta name="date" content="1990-01-01">').otherwise("")
    tag = F.when(i == 2, F.concat(F.lit('<time datetime="'), _day(), F.lit('">'))).when(i < 2, '<time datetime="1991-01-01">').otherwise("")
    ago = F.when(i <= 3, "<p>2 days ago</p>").otherwise("<p>text</p>")
    rfc = F.date_format("day", "EEE', 'dd MMM yyyy HH:mm:ss' GMT'")
    found = dates.waterfall(F.concat(ld, meta, tag, ago), F.when(i <= 4, rfc), F.when(i <= 5, rfc), now_col())
    return _orders(spark, sf).select("o_orderkey", found.alias("d")).select("o_orderkey", "d.at", "d.label")


@query(
    "freshness_24h",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE round(epoch_us({NOW} - INTERVAL 12 HOUR - ts) / 3.6e9, 4) END AS age_hours,
    CASE WHEN event_id % 10 = 0 THEN false ELSE epoch_us({NOW} - INTERVAL 12 HOUR - ts) BETWEEN 0 AND 86400000000 END AS fresh FROM events""",
)
def freshness_24h(spark, sf):
    at, now = F.when(F.col("event_id") % 10 != 0, F.col("ts")), now_col() - F.expr("INTERVAL 12 HOURS")
    return table(spark, sf, "events").select("event_id", F.round(dates.age_hours(at, now), 4).alias("age_hours"), dates.is_fresh(at, now).alias("fresh"))


@query(
    "fresh_stale_dateless",
    """SELECT event_type, count(*) FILTER (WHERE event_id % 10 <> 0 AND ts BETWEEN {NOW} - INTERVAL 36 HOUR AND {NOW} - INTERVAL 12 HOUR) AS fresh,
    count(*) FILTER (WHERE event_id % 10 <> 0 AND NOT ts BETWEEN {NOW} - INTERVAL 36 HOUR AND {NOW} - INTERVAL 12 HOUR) AS stale, count(*) FILTER (WHERE event_id % 10 = 0) AS dateless FROM events GROUP BY event_type""",
)
def fresh_stale_dateless(spark, sf):
    at, now = F.when(F.col("event_id") % 10 != 0, F.col("ts")), now_col() - F.expr("INTERVAL 12 HOURS")
    rows = table(spark, sf, "events").select("event_type", at.alias("at"), dates.is_fresh(at, now).alias("fresh"))
    return rows.groupBy("event_type").agg(F.count_if("fresh").alias("fresh"), F.count_if(F.col("at").isNotNull() & ~F.col("fresh")).alias("stale"), F.count_if(F.col("at").isNull()).alias("dateless"))


@query(
    "date_precedence",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) WHEN o_orderkey % 3 = 1 THEN CAST(date_trunc('day', o_orderdate) + INTERVAL 1 DAY AS TIMESTAMP) END AS at,
    CASE WHEN o_orderkey % 3 = 0 THEN 'first_published' ELSE 'updated_at' END AS date_source FROM orders""",
)
def date_precedence(spark, sf):
    i = F.col("o_orderkey") % 3
    first, updated = dates.parse_utc(F.when(i == 0, _day())), dates.parse_utc(F.when(i < 2, F.date_format(F.col("day") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")).otherwise("never"))
    return _orders(spark, sf).select("o_orderkey", F.coalesce(first, updated).alias("at"), F.when(first.isNotNull(), "first_published").otherwise("updated_at").alias("date_source"))


@query("epoch_millis", "SELECT event_id, CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS TIMESTAMP) AS at FROM events")
def epoch_millis(spark, sf):
    return table(spark, sf, "events").select("event_id", F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("at"))
