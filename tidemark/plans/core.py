"""Projections, filters, counts, limits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.plans.registry import query
from tidemark.sources import sinks
from tidemark.sources.readers import table


@query("scan_filter_project", "SELECT doc_id, upper(lang) AS lang, source, n_chars FROM documents WHERE n_chars > 1000 AND lang = 'en'")
def scan_filter_project(spark, sf):
    return table(spark, sf, "documents").where("n_chars > 1000 AND lang = 'en'").select("doc_id", F.upper("lang").alias("lang"), "source", "n_chars")


@query("counts_by_type", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def counts_by_type(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "conditional_counts",
    "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in ("click", "view", "error", "purchase", "login")) + " FROM events",
)
def conditional_counts(spark, sf):
    kinds = ("click", "view", "error", "purchase", "login")
    return table(spark, sf, "events").agg(F.count("*").alias("total"), *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in kinds])


@query("score_min_max", "SELECT event_type, min(value) AS lowest, max(value) AS highest FROM events GROUP BY event_type")
def score_min_max(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query("limit_stable", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 60")
def limit_stable(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(60)


@query("newest_first", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 100")
def newest_first(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(100)


@query(
    "union_sources",
    "SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey FROM supplier UNION ALL SELECT 'part', p_partkey, p_name, NULL FROM part",
)
def union_sources(spark, sf):
    customers = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    parts = table(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return customers.unionByName(suppliers).unionByName(parts, allowMissingColumns=True)


@query("topn_per_group", "SELECT lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 40")
def topn_per_group(spark, sf):
    return sinks.first_per_type(table(spark, sf, "documents"), "lang", [F.desc("n_chars"), F.col("doc_id")], 40).select("lang", "doc_id", "n_chars")


@query(
    "web_extract",
    """WITH r AS (SELECT doc_id, ['STARTUP', 'PRODUCT', 'RESEARCH_PAPER', 'JOB', 'NEWS'][CAST(doc_id % 5 AS INT) + 1] AS kind FROM documents)
    SELECT doc_id, kind FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY doc_id) AS k FROM r) WHERE k <= 400 OR kind IN ('JOB', 'NEWS')""",
)
def web_extract(spark, sf):
    return sinks.web_extract(typed(spark, sf).select("doc_id", "kind"), "kind", ["doc_id"])


def typed(spark, sf):
    """Documents with a record type by id."""
    kinds = F.array(*map(F.lit, ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]))
    return table(spark, sf, "documents").withColumn("kind", F.element_at(kinds, (F.col("doc_id") % 5 + 1).cast("int")))


@query(
    "tab_counts",
    """WITH r AS (SELECT ['Startups', 'Products', 'Research Papers', 'Jobs', 'News'][CAST(doc_id % 5 AS INT) + 1] AS tab FROM documents)
    SELECT tab, count(*) AS rows, count(*) >= CASE WHEN tab IN ('Jobs', 'News') THEN 0 ELSE 1000 END AS ok FROM r GROUP BY tab""",
)
def tab_counts(spark, sf):
    return sinks.tab_counts(typed(spark, sf).withColumnRenamed("kind", "recordType"))


@query(
    "flatten_export",
    """SELECT CAST(c_custkey AS VARCHAR) AS "id", CASE WHEN c_acctbal > 0 THEN 'TRUE' ELSE 'FALSE' END AS "content.positive",
    coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, '') AS "content.segment", '["' || c_name || '","' || c_mktsegment || '"]' AS "content.tags", '' AS "content.missing" FROM customer""",
)
def flatten_export(spark, sf):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    content = F.struct((F.col("c_acctbal") > 0).alias("positive"), segment.alias("segment"), F.array("c_name", "c_mktsegment").alias("tags"))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), content.alias("content"))
    return sinks.flatten(rows, ["id", "content.positive", "content.segment", "content.tags", "content.missing"])


@query(
    "display_slices",
    """SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, ''), lang, 'Entity Record') AS title,
    array_to_string(list_slice(string_split(text, ' '), 1, 3), ', ') AS authors, substring(text, 1, 140) || '...' AS summary, regexp_replace('RESEARCH_PAPER_X', '_', ' ') AS label FROM documents""",
)
def display_slices(spark, sf):
    title = F.coalesce(F.nullif(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")), F.lit("")), "lang", F.lit("Entity Record"))
    return table(spark, sf, "documents").select(
        "doc_id",
        title.alias("title"),
        F.array_join(F.slice(F.split("text", " "), 1, 3), ", ").alias("authors"),
        F.concat(F.substring("text", 1, 140), F.lit("...")).alias("summary"),
        F.regexp_replace(F.lit("RESEARCH_PAPER_X"), "^([^_]*)_", "$1 ").alias("label"),
    )


@query("seeded_sample")
def seeded_sample(spark, sf):
    """Fifty documents in the order of a hash of id and seed."""
    return table(spark, sf, "documents").select("doc_id", "source").orderBy(F.xxhash64("doc_id", F.lit(42)), "doc_id").limit(50)


@query("usage_counts", "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS searches FROM events WHERE event_type = 'view' GROUP BY ALL")
def usage_counts(spark, sf):
    return table(spark, sf, "events").where("event_type = 'view'").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("searches"))


@query("new_vs_seen", "SELECT o_custkey AS custkey FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 4 = 0) a WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderkey % 4 = 1)")
def new_vs_seen(spark, sf):
    orders = table(spark, sf, "orders")
    seen = orders.where("o_orderkey % 4 = 1").select("o_custkey")
    return orders.where("o_orderkey % 4 = 0").select("o_custkey").distinct().join(seen, "o_custkey", "left_anti").select(F.col("o_custkey").alias("custkey"))


@query(
    "fk_joins",
    """SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS total
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name, n_name""",
)
def fk_joins(spark, sf):
    # region and nation are fixed lists; orders are summed per customer before the join
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"))
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).join(per, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy("r_name", "n_name").agg(F.count("*").alias("customers"), F.coalesce(F.sum("k"), F.lit(0)).alias("orders"), F.sum("t").cast("double").alias("total"))


@query(
    "upsert_versions",
    """WITH cur AS (SELECT c_custkey AS id, c_acctbal AS bal, 1 AS version FROM customer WHERE c_custkey % 3 <> 0), chg AS (SELECT c_custkey AS id, c_acctbal + 1 AS bal FROM customer WHERE c_custkey % 2 = 0)
    SELECT id, bal, version FROM cur WHERE id NOT IN (SELECT id FROM chg) UNION ALL SELECT chg.id, chg.bal, coalesce(cur.version + 1, 1) FROM chg LEFT JOIN cur USING (id)""",
)
def upsert_versions(spark, sf):
    customer = table(spark, sf, "customer")
    current = customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.lit(1).alias("version"))
    changes = customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") + 1).alias("bal"))
    return sinks.upsert(current, changes, ["id"])


EVENT_FLAGS = {"accepted": "event_id % 3 = 0", "duplicate": "event_id % 7 = 1", "stale": "event_id % 5 = 2", "error": "event_type = 'error'", "limited": "event_id % 11 = 3", "timeout": "event_id % 13 = 4"}


def crawl_events(spark, sf):
    """Events as crawl telemetry: the flags are conditions on id and type, freshness is the value where accepted."""
    flags = {k: F.expr(v) for k, v in EVENT_FLAGS.items()}
    return table(spark, sf, "events").withColumns({"source": F.col("event_type"), "seq": F.col("event_id"), **flags, "freshness": F.expr("CASE WHEN event_id % 3 = 0 THEN value END")})


_FLAGGED = "SELECT event_type AS source, event_id AS seq, ts, value, " + ", ".join(f"({v}) AS {k}" for k, v in EVENT_FLAGS.items()) + " FROM events"
_COUNTS = "count(*) AS crawled, count_if(accepted) AS accepted, count_if(duplicate) AS duplicates, count_if(stale) AS stale, count_if(error) AS errors, count_if(limited) AS limited, count_if(timeout) AS timeouts"


@query("source_metrics", f"SELECT source, {_COUNTS}, max(ts) AS last_crawl FROM ({_FLAGGED}) GROUP BY source")
def source_metrics(spark, sf):
    return metrics.source_metrics(crawl_events(spark, sf)).drop("avg_freshness_hours")


@query(
    "freshness_ewma",
    f"""SELECT source, list_reduce(list_transform(list(value ORDER BY seq) FILTER (WHERE accepted), lambda x: round(x, 2)), lambda a, x: round(0.8 * a + 0.2 * x, 2)) AS avg_freshness_hours
    FROM ({_FLAGGED}) GROUP BY source""",
)
def freshness_ewma(spark, sf):
    return metrics.source_metrics(crawl_events(spark, sf)).select("source", "avg_freshness_hours")


@query(
    "health_report",
    f"""WITH m AS (SELECT source, {_COUNTS} FROM ({_FLAGGED}) GROUP BY source)
    SELECT count(*) AS sources, CAST(sum(crawled) AS BIGINT) AS total_crawled, CAST(sum(accepted) AS BIGINT) AS total_accepted, CAST(sum(duplicates) AS BIGINT) AS total_duplicates, CAST(sum(stale) AS BIGINT) AS total_stale, CAST(sum(errors) AS BIGINT) AS total_errors, CAST(sum(limited) AS BIGINT) AS total_limited,
    round(sum(duplicates) * 100.0 / (sum(accepted) + sum(duplicates)), 4) AS duplication_rate, CASE WHEN sum(errors) + sum(limited) > 50 THEN 'DEGRADED' ELSE 'HEALTHY' END AS health FROM m""",
)
def health_report(spark, sf):
    return metrics.report(metrics.source_metrics(crawl_events(spark, sf)))


@query(
    "event_windows",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, min(value) AS lowest FROM events GROUP BY ALL""",
)
def event_windows(spark, sf):
    return table(spark, sf, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.min("value").alias("lowest")).select(F.col("w.start").alias("day"), "event_type", "n", "lowest")


@query(
    "price_rollup",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
)
def price_rollup(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
