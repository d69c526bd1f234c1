"""Scores, verification, lineage, changes, and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scoring, text
from tidemark.operators import dedup, incremental, lineage, verify
from tidemark.plans.datequeries import now_col
from tidemark.plans.registry import query
from tidemark.sources import delivery
from tidemark.sources.readers import table
from tidemark.tables import fresh_path

_SOURCES = ["https://export.arxiv.org/api", "https://techcrunch.com/x", "https://paperswithcode.com/p", "https://example.com"]
_METHODS = ["api_structured", "html_parsing", "browser_render", "fuzzy", "manual"]
_SQL_RECORDS = """WITH r AS (SELECT event_id, ['https://export.arxiv.org/api', 'https://techcrunch.com/x', 'https://paperswithcode.com/p', 'https://example.com'][CAST(event_id % 4 AS INT) + 1] AS url,
    ['api_structured', 'html_parsing', 'browser_render', 'fuzzy', 'manual'][CAST(event_id % 5 AS INT) + 1] AS method, CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS pub, event_id % 6 = 0 AS corroborated, event_id % 10 = 3 AS disputed, event_id % 7 = 0 AS incomplete FROM events),
  p AS (SELECT *, CASE event_id % 4 WHEN 0 THEN 100.0 WHEN 1 THEN 92.0 WHEN 2 THEN 85.0 ELSE 70.0 END AS reliability, epoch_us({NOW} - pub) / 3.6e9 AS age FROM r),
  s AS (SELECT event_id, CAST(reliability AS DOUBLE) AS reliability, CAST(CASE WHEN corroborated THEN 100 WHEN reliability >= 95 AND NOT incomplete THEN 80 WHEN reliability >= 95 THEN 65 WHEN NOT incomplete THEN 70 ELSE 50 END AS DOUBLE) AS corroboration,
    CAST(CASE WHEN pub IS NULL THEN 50 WHEN age <= 24 THEN 100 WHEN age <= 168 THEN 85 WHEN age <= 720 THEN 70 ELSE 55 END AS DOUBLE) AS freshness, CAST([100, 90, 80, 75, 70][CAST(event_id % 5 AS INT) + 1] AS DOUBLE) AS confidence, CAST(CASE WHEN disputed THEN 25 ELSE 0 END AS DOUBLE) AS penalty FROM p),
  t AS (SELECT *, greatest(0.0, least(100.0, round(0.30 * reliability + 0.25 * corroboration + 0.25 * freshness + 0.20 * confidence - penalty, 2))) AS total FROM s)
"""


def _scored(spark, sf):
    i = F.col("event_id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    at = F.when(i % 9 != 0, F.col("ts"))
    parts = scoring.breakdown(pick(_SOURCES), at, F.lit(None).cast("timestamp_ntz"), i % 6 == 0, i % 10 == 3, pick(_METHODS), i % 7 == 0, now_col())
    return table(spark, sf, "events").select("event_id", parts.alias("s"))


@query("quality_score", _SQL_RECORDS + "SELECT event_id, CAST(total AS DOUBLE) AS total FROM t")
def quality_score(spark, sf):
    return _scored(spark, sf).select("event_id", "s.total")


@query("score_components", _SQL_RECORDS + "SELECT event_id, reliability, corroboration, freshness, confidence, penalty FROM t")
def score_components(spark, sf):
    return _scored(spark, sf).select("event_id", "s.reliability", "s.corroboration", "s.freshness", "s.confidence", "s.penalty")


@query(
    "page_quality_tiers",
    r"""WITH k AS (SELECT page_id, 'startup_domain:' || replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), 'www.', '') AS key, url FROM pages),
    f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS n FROM k)
    SELECT CASE WHEN page_id % 4 = 0 THEN 'A' ELSE 'B' END AS tier, count(*) AS pages, round(avg(0.30 * 70 + 0.25 * CASE WHEN page_id % 4 = 0 THEN 100 ELSE 70 END + 0.25 * 50 + 0.20 * 90), 4) AS mean_score FROM f WHERE n = 1 GROUP BY 1""",
)
def page_quality_tiers(spark, sf):
    """First-wins records by host, scored, by tier."""
    pages = table(spark, sf, "pages").select("page_id", "url", text.exact_key(F.lit("STARTUP"), F.col("url"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("key"))
    first = dedup.first_wins(pages, "key", "page_id")
    none, good = F.lit(None).cast("timestamp_ntz"), F.col("page_id") % 4 == 0
    total = scoring.breakdown(F.col("url"), none, none, good, F.lit(False), F.lit("html_parsing"), F.lit(False), now_col())["total"]
    return first.groupBy(F.when(good, "A").otherwise("B").alias("tier")).agg(F.count("*").alias("pages"), F.round(F.avg(total), 4).alias("mean_score"))


def _observations(spark, sf):
    """Line items as observations of a part's return flag by suppliers."""
    order = F.struct("l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("entity"), F.lit("flag").alias("field"), F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("value"), order.alias("seq"))


_OBS = """WITH o AS (SELECT CAST(l_partkey AS VARCHAR) AS entity, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS value, row(l_orderkey, l_linenumber) AS seq FROM lineitem),
  g AS (SELECT entity, count(*) AS observations, count(value) AS non_null, count(DISTINCT lower(trim(value))) AS distinct_values, arg_min(value, seq) FILTER (WHERE value IS NOT NULL) AS canonical FROM o GROUP BY entity),
  v AS (SELECT *, CASE WHEN non_null <= 1 THEN 'SINGLE_SOURCE' WHEN distinct_values = 1 THEN 'VERIFIED' ELSE 'DISPUTED' END AS status, CAST(CASE WHEN non_null = 0 THEN 0.5 WHEN non_null = 1 THEN 0.75 WHEN distinct_values = 1 THEN 1.0 ELSE 0.45 END AS DOUBLE) AS confidence FROM g)
"""


@query("verify_fields", _OBS + "SELECT entity, observations, non_null, distinct_values, canonical, status, confidence FROM v")
def verify_fields(spark, sf):
    return verify.verify_fields(_observations(spark, sf)).select("entity", "observations", "non_null", "distinct_values", "canonical", "status", "confidence")


@query(
    "quality_flags",
    _OBS + ", f AS (SELECT entity, lower(trim(value)) AS v, min(seq) AS s, arg_min(value, seq) AS value FROM o WHERE value IS NOT NULL GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY s) AS n FROM f) "
    "SELECT v.entity, a.value AS expected, b.value AS actual, CAST(45 AS DOUBLE) AS quality_score FROM v JOIN k a ON a.entity = v.entity AND a.n = 1 JOIN k b ON b.entity = v.entity AND b.n = 2 WHERE v.status = 'DISPUTED'",
)
def quality_flags(spark, sf):
    return verify.quality_flags(verify.verify_fields(_observations(spark, sf))).select("entity", "expected", "actual", "quality_score")


@query(
    "verified_scores",
    _OBS + "SELECT entity, CAST(round(0.30 * 70 + 0.25 * CASE WHEN status = 'VERIFIED' THEN 100 ELSE 70 END + 0.25 * 50 + 0.20 * 100 - CASE WHEN status = 'DISPUTED' THEN 25 ELSE 0 END, 2) AS DOUBLE) AS total FROM v",
)
def verified_scores(spark, sf):
    """Scores that take corroboration and disputes from the verification."""
    v = verify.verify_fields(_observations(spark, sf))
    none = F.lit(None).cast("timestamp_ntz")
    total = scoring.breakdown(F.lit("https://example.com"), none, none, F.col("status") == "VERIFIED", F.col("status") == "DISPUTED", F.lit("api_structured"), F.lit(False), now_col())["total"]
    return v.select("entity", total.alias("total"))


@query(
    "content_changed",
    "SELECT conv_id, turn, text IS DISTINCT FROM lag(text) OVER w OR row_number() OVER w = 1 AS changed FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'same' ELSE role END AS text FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)",
)
def content_changed(spark, sf):
    return _crawls(spark, sf).select("conv_id", "turn", "changed")


def _crawls(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, "same").otherwise(F.col("role")).alias("body"))
    return incremental.changed(rows, "conv_id", "turn", "body")


@query(
    "doc_versions",
    "WITH c AS (SELECT conv_id, turn, (text IS DISTINCT FROM lag(text) OVER w OR row_number() OVER w = 1)::INT AS c FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'same' ELSE role END AS text FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) "
    "SELECT conv_id, turn, CAST(sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS version FROM c",
)
def doc_versions(spark, sf):
    return _crawls(spark, sf).select("conv_id", "turn", "version")


@query("crawl_state", "SELECT conv_id, arg_max(sha256(text), turn) AS last_seen_hash, max(turn) AS last_crawled_at, arg_max(etag, turn) FILTER (WHERE etag <> '') AS etag FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN role ELSE '' END AS etag FROM conversations) GROUP BY conv_id")
def crawl_state(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("etag", F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(""))
    return incremental.crawl_state(rows, "conv_id", "turn", "text")


@query(
    "saved_state",
    """SELECT CAST(conv_id AS VARCHAR) || ' "é"' AS url, arg_max(sha256(text), turn) AS last_seen_hash, CAST(max(turn) AS VARCHAR) AS last_crawled_at, arg_max(etag, turn) FILTER (WHERE etag <> '') AS etag
    FROM (SELECT *, CASE WHEN turn % 2 = 0 THEN role ELSE '' END AS etag FROM conversations) GROUP BY conv_id""",
)
def saved_state(spark, sf):
    """The state of every conversation, saved as JSON objects by address and loaded again."""
    folder = fresh_path(spark)
    state = crawl_state(spark, sf).withColumn("url", F.concat(F.col("conv_id").cast("string"), F.lit(' "é"')))
    delivery.save_state(state.drop("conv_id"), folder)
    return delivery.load_state(spark, folder).select("url", "last_seen_hash", "last_crawled_at", "etag")


@query("refetch_due", "SELECT user_id, max(ts) IS NULL OR epoch_us(TIMESTAMP '2024-01-29 00:00:00' - max(ts)) >= 300000000 AS due FROM events GROUP BY user_id")
def refetch_due(spark, sf):
    last = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.select("user_id", incremental.due(F.col("last"), F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")).alias("due"))


@query(
    "cached_stars",
    "SELECT r.user_id AS repo, s.stars FROM (SELECT DISTINCT user_id FROM events) r LEFT JOIN (SELECT user_id, arg_max(value, ts) AS stars FROM events WHERE event_type = 'view' AND epoch_us({NOW} - INTERVAL 36 HOUR - ts) < 86400000000 GROUP BY user_id) s USING (user_id)",
)
def cached_stars(spark, sf):
    events = table(spark, sf, "events").withColumn("repo", F.col("user_id"))
    snapshot = events.where("event_type = 'view'").select("repo", F.col("value").alias("stars"), F.col("ts").alias("fetched_at"))
    return incremental.cached_stars(events.select("repo").distinct(), snapshot, now_col() - F.expr("INTERVAL 36 HOURS"))


@query(
    "lineage_chains",
    "SELECT page_id, sha256('STARTUP|' || url || '|run1') AS record_id, 'STARTUP:' || url AS dedup_key FROM (SELECT *, row_number() OVER (ORDER BY page_id) AS k FROM pages) WHERE k <= 50",
)
def lineage_chains(spark, sf):
    pages = table(spark, sf, "pages").orderBy("page_id").limit(50).select("page_id", F.lit("STARTUP").alias("record_type"), F.col("url").alias("source_url"))
    return lineage.chains(pages, "run1").select("page_id", "record_id", "dedup_key")


@query("latest_lineage", "SELECT conv_id AS record_id, max(turn) AS seq, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id")
def latest_lineage(spark, sf):
    return lineage.latest(table(spark, sf, "conversations").select(F.col("conv_id").alias("record_id"), F.col("turn").alias("seq"), "role"))
