"""Deduplication, resolution and parsing of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import dedup, htmlclean, resolve
from tidemark.plans.registry import query
from tidemark.plans.datequeries import now_col
from tidemark.plans.textqueries import _names, _sql_key, _sql_name, _VARIANT
from tidemark.sources import parsers
from tidemark.sources.readers import table


@query("dedup_exact", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_exact(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", text.content_hash(F.col("text")).alias("key"))
    return dedup.first_wins(docs, "key", "doc_id").select("doc_id")


@query("dedup_normalized", f"SELECT p_partkey, key FROM (SELECT p_partkey, {_sql_key(_VARIANT)} AS key, row_number() OVER (PARTITION BY {_sql_key(_VARIANT)} ORDER BY p_partkey) AS k FROM part) WHERE k = 1")
def dedup_normalized(spark, sf):
    names = _names(spark, sf).select("p_partkey", text.normalize_key(F.col("name")).alias("key"))
    return dedup.first_wins(names, "key", "p_partkey")


def _records(spark, sf):
    """Parts as startups: every seventh shares its address with an earlier one, and names repeat with other endings."""
    names = _names(spark, sf)
    i = F.col("p_partkey")
    kind = F.when(i % 3 == 0, "PRODUCT").otherwise("STARTUP")
    return names.select(i.alias("seq"), F.concat(F.lit("url:"), F.when(i % 7 == 0, i - 7).otherwise(i)).alias("exact"), text.normalize_key(F.col("name")).alias("norm"), text.block_key(F.col("name"), kind).alias("block"))


_SQL_RECORDS = f"""r AS MATERIALIZED (SELECT p_partkey AS seq, 'url:' || CASE WHEN p_partkey % 7 = 0 THEN p_partkey - 7 ELSE p_partkey END AS exact, {_sql_key(_VARIANT)} AS norm,
  CASE WHEN p_partkey % 3 = 0 THEN 'PRODUCT' ELSE 'STARTUP' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'PRODUCT' ELSE 'STARTUP' END || ':' || substring({_sql_key(_VARIANT)}, 1, 2) AS block FROM part)"""


@query(
    "fuzzy_pairs",
    f"WITH {_SQL_RECORDS}, n AS (SELECT DISTINCT block, norm FROM r WHERE norm <> '') SELECT a.block, a.norm AS a, b.norm AS b, round(jaro_winkler_similarity(a.norm, b.norm), 6) AS score FROM n a JOIN n b ON a.block = b.block AND a.norm < b.norm WHERE jaro_winkler_similarity(a.norm, b.norm) >= 0.9",
)
def fuzzy_pairs(spark, sf):
    return dedup.fuzzy_pairs(_records(spark, sf), 0.90).withColumn("score", F.round("score", 6))


_SURVIVORS = f"""WITH RECURSIVE {_SQL_RECORDS}, o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM r),
  e AS MATERIALIZED (SELECT b.k AS j, list(a.k) AS js FROM o b LEFT JOIN o a ON a.k < b.k AND (a.exact = b.exact OR a.kind = b.kind AND a.norm = b.norm OR a.block = b.block AND a.norm <> '' AND b.norm <> '' AND jaro_winkler_similarity(a.norm, b.norm) >= 0.9) GROUP BY b.k),
  s AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT s.k + 1, CASE WHEN list_has_any(s.kept, e.js) THEN s.kept ELSE list_append(s.kept, s.k + 1) END FROM s JOIN e ON e.j = s.k + 1)
"""


@query("dedup_survivors", _SURVIVORS + "SELECT o.seq, CASE WHEN list_contains(f.kept, o.k) THEN 'keep' ELSE 'duplicate' END AS status FROM o, (SELECT kept FROM s ORDER BY k DESC LIMIT 1) f")
def dedup_survivors(spark, sf):
    return dedup.survivors(_records(spark, sf), 0.90).select("seq", "status")


@query(
    "dedup_stats",
    _SURVIVORS + "SELECT count(*) AS total_seen, count_if(NOT k) AS duplicates, count(DISTINCT exact) FILTER (WHERE k) AS exact_keys, count(DISTINCT norm) FILTER (WHERE k) AS normalized_keys, count(DISTINCT block) FILTER (WHERE k) AS blocks "
    "FROM (SELECT o.*, list_contains(f.kept, o.k) AS k FROM (SELECT * EXCLUDE (k), k FROM o) o, (SELECT kept FROM s ORDER BY k DESC LIMIT 1) f) x(seq, exact, norm, kind, block, kk, k)",
)
def dedup_stats(spark, sf):
    return dedup.dedup_stats(dedup.survivors(_records(spark, sf), 0.90))


#: A small seed dimension: name, aliases, domain.
_SEEDS = [("OpenAI", ["Open AI", "OpenAI LP"], "openai.com"), ("Stability AI", ["StabilityAI"], "stability.ai"), ("Hugging Face", ["HF"], "huggingface.co"), ("Weights & Biases", ["wandb"], "wandb.ai"), ("Anthropic", ["Anthropic PBC"], "anthropic.com")]
_RAW = ["open ai", "OpenAI, Inc.", "Stabilty AI", "Hugging Fase", "Huge Faces", "Totally New", "  ", "wandb", "Anthropc Research", "Weights and Biases"]
_DOMAINS = ["", "", "", "", "www.huggingface.co", "", "", "", "", ""]


def _resolved(spark, sf):
    seeds = spark.createDataFrame([(i, n, a, d) for i, (n, a, d) in enumerate(_SEEDS)], "ordinal int, canonical_name string, aliases array<string>, domain string")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("s_suppkey") % 10 + 1).cast("int"))
    raw = table(spark, sf, "supplier").select("s_suppkey", pick(_RAW).alias("raw_name"), F.nullif(pick(_DOMAINS), F.lit("")).alias("domain"), F.concat(F.lit("https://x.com/"), "s_suppkey").alias("source_url"))
    return resolve.resolve(raw, seeds, domain="domain")


_seed_rows = ", ".join(f"({i}, '{n}', [{', '.join(repr(x) for x in [n, *a])}], '{d}')" for i, (n, a, d) in enumerate(_SEEDS))
_RESOLVED = f"""WITH seeds(ordinal, name, aliases, domain) AS (VALUES {_seed_rows}), al AS (SELECT lower(unnest(aliases)) AS alias, name, ordinal FROM seeds),
  raw AS (SELECT s_suppkey, [{', '.join(repr(x) for x in _RAW)}][CAST(s_suppkey % 10 AS INT) + 1] AS raw_name, nullif([{', '.join(repr(x) for x in _DOMAINS)}][CAST(s_suppkey % 10 AS INT) + 1], '') AS domain FROM supplier),
  n AS (SELECT *, trim(raw_name) AS t, {_sql_name('trim(raw_name)')} AS norm FROM raw),
  sn AS (SELECT {_sql_name('alias')} AS norm, arg_max(name, ordinal) AS name FROM al GROUP BY 1),
  best AS (SELECT norm, arg_max(name, row(score, -ordinal)) AS name, max(score) AS score FROM (SELECT DISTINCT n.norm, s.name, s.ordinal, jaro_winkler_similarity(n.norm, {_sql_name('s.name')}) AS score FROM n, seeds s WHERE n.norm <> '') GROUP BY norm),
  j AS (SELECT n.*, (SELECT arg_max(name, ordinal) FROM al WHERE alias = lower(t)) AS a, (SELECT name FROM sn WHERE sn.norm = n.norm AND n.norm <> '') AS b, (SELECT arg_min(name, ordinal) FROM seeds s WHERE s.domain = lower(replace(n.domain, 'www.', ''))) AS c, best.name AS d, coalesce(best.score, 0) AS score FROM n LEFT JOIN best USING (norm)),
  z AS (SELECT s_suppkey, raw_name, CASE WHEN t = '' THEN NULL WHEN a IS NOT NULL THEN a WHEN b IS NOT NULL THEN b WHEN c IS NOT NULL THEN c WHEN score >= 0.92 THEN d WHEN score >= 0.7 THEN NULL ELSE t END AS canonical,
    CASE WHEN t = '' OR a IS NOT NULL THEN 'exact_alias' WHEN b IS NOT NULL THEN 'normalization' WHEN c IS NOT NULL THEN 'context_match' WHEN score >= 0.92 THEN 'fuzzy_match' WHEN score >= 0.7 THEN 'manual_review' ELSE 'exact_alias' END AS method,
    CAST(CASE WHEN t = '' THEN 0.0 WHEN a IS NOT NULL THEN 1.0 WHEN b IS NOT NULL THEN 0.98 WHEN c IS NOT NULL THEN 0.95 WHEN score >= 0.7 THEN round(score, 4) ELSE 1.0 END AS DOUBLE) AS confidence,
    CASE WHEN t = '' THEN 'REJECTED' WHEN a IS NULL AND b IS NULL AND c IS NULL AND score >= 0.7 AND score < 0.92 THEN 'REVIEW' ELSE 'ACCEPTED' END AS decision FROM j)
"""


@query("resolve_entities", _RESOLVED + "SELECT s_suppkey, raw_name, canonical, method, confidence, decision FROM z")
def resolve_entities(spark, sf):
    return _resolved(spark, sf).select("s_suppkey", "raw_name", "canonical", "method", "confidence", "decision")


@query("mapping_log", _RESOLVED + """SELECT raw_name AS "rawName", canonical AS "canonicalName", method, confidence, 'https://x.com/' || s_suppkey AS "sourceUrl", decision FROM z WHERE decision <> 'REJECTED'""")
def mapping_log(spark, sf):
    return resolve.mapping_log(_resolved(spark, sf))


@query("resolution_counts", _RESOLVED + "SELECT method, decision, count(*) AS n FROM z GROUP BY ALL")
def resolution_counts(spark, sf):
    return _resolved(spark, sf).groupBy("method", "decision").agg(F.count("*").alias("n"))


def _markdown(spark, sf):
    """A Markdown list per supplier."""
    i = F.col("s_suppkey")
    body = F.concat(
        F.lit("# List\n- [Intro](https://intro.com)\n## Tools\n* [Alpha "), i, F.lit("](https://alpha"), i, F.lit(".com/x) - built by Acme Labs, open source\n- [License](https://l.com): no\n- [GH](https://github.com/a/b)\n## Milestones\n- [Skipped](https://skip.com)\n### Chat\n"),
        F.lit("- [Beta](https://www.beta"), i % 5, F.lit(".org) – $9 a month and [Gamma](https://gamma.io/"), i, F.lit(")\n- [Beta again](https://beta"), i % 5, F.lit(".org/2)\n### Delta\ntext\n[More Information and Pricing](https://delta"), i, F.lit(".ai)\n[More Information and Pricing](https://late.ai)\n"),
    )
    return table(spark, sf, "supplier").select("s_suppkey", body.alias("body"))


@query(
    "markdown_links",
    """SELECT s_suppkey, unnest(['Intro', 'Alpha ' || s_suppkey, 'Beta', 'Gamma', 'More Information and Pricing', 'More Information and Pricing']) AS name,
    unnest(['https://intro.com', 'https://alpha' || s_suppkey || '.com/x', 'https://www.beta' || s_suppkey % 5 || '.org', 'https://gamma.io/' || s_suppkey, 'https://delta' || s_suppkey || '.ai', 'https://late.ai']) AS link, unnest(['general', 'tools', 'chat', 'chat', 'delta', 'delta']) AS section FROM supplier""",
)
def markdown_links(spark, sf):
    return parsers.markdown_startups(_markdown(spark, sf), "body").select("s_suppkey", "name", "link", "section")


@query(
    "markdown_products",
    """SELECT s_suppkey, unnest(['Intro', 'Alpha ' || s_suppkey, 'GH', 'Beta', 'Beta again']) AS name, unnest([NULL, 'Acme Labs', 'GitHub', NULL, NULL]) AS company, unnest([NULL, 'FREE', NULL, 'PAID', NULL]) AS pricing FROM supplier""",
)
def markdown_products(spark, sf):
    return parsers.markdown_products(_markdown(spark, sf), "body").select("s_suppkey", "name", "company", "pricing")


@query("heading_link_pairs", "SELECT s_suppkey, 'Delta' AS name, 'https://delta' || s_suppkey || '.ai' AS link FROM supplier")
def heading_link_pairs(spark, sf):
    return parsers.heading_links(_markdown(spark, sf), "body").select("s_suppkey", "name", "link")


@query("section_carry", """SELECT s_suppkey, section, count(*) AS lines FROM (SELECT s_suppkey, unnest([NULL, NULL, 'tools', 'tools', 'tools', 'tools', 'milestones', 'milestones', 'chat', 'chat', 'chat', 'delta', 'delta', 'delta', 'delta', 'delta']) AS section FROM supplier) GROUP BY ALL""")
def section_carry(spark, sf):
    return parsers.lines(_markdown(spark, sf), "body").groupBy("s_suppkey", "section").agg(F.count("*").alias("lines"))


def _payload(spark, sf, body):
    return table(spark, sf, "supplier").select("s_suppkey", body.alias("body"))


@query(
    "greenhouse_jobs",
    """SELECT s_suppkey, unnest(['https://j/1', 'https://j/3']) AS url, unnest(['Data Analyst', 'Sales Lead']) AS title, unnest([true, false]) AS is_remote, unnest(['DATA', 'SALES']) AS role_family, unnest(['first_published', 'updated_at']) AS date_source, CAST(unnest([12.0, 6.0]) AS DOUBLE) AS age_hours FROM supplier""",
)
def greenhouse_jobs(spark, sf):
    job = lambda u, t, f, up, loc: f'{{"absolute_url":"{u}","title":"{t}","first_published":{f},"updated_at":"{up}","location":{{"name":"{loc}"}}}}'
    jobs = [
        job("https://j/1", "Data Analyst", '"2024-01-30T12:00:00Z"', "2024-01-30T23:00:00Z", "Remote EU"),
        job("https://j/2", "Old", '"2023-11-01T00:00:00Z"', "2024-01-30T23:00:00Z", "Berlin"),
        job("https://j/3", "Sales Lead", "null", "2024-01-30T18:00:00+00:00", "Paris"),
        job("", "No url", "null", "2024-01-30T18:00:00+00:00", "Paris"),
    ]
    body = F.lit('{"jobs":[' + ",".join(jobs) + "]}")
    return parsers.greenhouse_jobs(_payload(spark, sf, body), "body", now_col()).select("s_suppkey", "url", "title", "is_remote", "role_family", "date_source", "age_hours")


def _text(*parts):
    """Literal and key parts as one text."""
    return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))


@query(
    "lever_jobs",
    """SELECT s_suppkey, 'https://l/apply/' || s_suppkey AS url, CASE WHEN s_suppkey % 2 = 0 THEN 'Backend Engineer' ELSE 'Account Executive' END AS title, s_suppkey % 3 = 0 AS is_remote,
    CASE WHEN s_suppkey % 2 = 0 THEN 'ENGINEERING' ELSE 'SALES' END AS role_family, CAST(s_suppkey * 5 % 36 AS DOUBLE) AS age_hours FROM supplier WHERE s_suppkey * 5 % 36 <= 24""",
)
def lever_jobs(spark, sf):
    i = F.col("s_suppkey")
    created = F.unix_millis(now_col().cast("timestamp")) - i * 5 % 36 * 3_600_000
    body = _text(
        '[{"text":"', F.when(i % 2 == 0, "Backend Engineer").otherwise("Account Executive"), '","createdAt":', created, ',"applyUrl":"https://l/apply/', i, '","categories":{"location":"', F.when(i % 3 == 0, "Anywhere").otherwise("Oslo"),
        '"}},{"text":"x","createdAt":1600000000000,"hostedUrl":"https://l/2"},{"text":"y"}]',
    )
    return parsers.lever_jobs(_payload(spark, sf, body), "body", now_col()).select("s_suppkey", "url", "title", "is_remote", "role_family", "age_hours")


@query(
    "remote_jobs",
    """WITH s AS (SELECT s_suppkey AS i, s_name AS n, s_suppkey * 5 % 36 AS age FROM supplier)
    SELECT i AS s_suppkey, CASE WHEN i % 4 = 0 THEN 'Remote Company' ELSE n END AS company, 'https://r/' || i AS url, 'DESIGN' AS role_family FROM s WHERE age <= 24 AND i % 5 <> 0
    UNION ALL SELECT i, 'Remote Company', 'https://r/b' || i, 'MARKETING' FROM s""",
)
def remote_jobs(spark, sf):
    i = F.col("s_suppkey")
    at = F.date_format(now_col() - F.make_dt_interval(hours=(i * 5 % 36).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    company = F.when(i % 4 == 0, "").otherwise(_text('"company":"', F.col("s_name"), '",'))
    url = F.when(i % 5 == 0, "").otherwise(_text("https://r/", i))
    body = _text('[{"legal":"note","url":"https://r/0","date":"2024-01-30T12:00:00Z"},{', company, '"position":"Designer","tags":["x"],"date":"', at, '","url":"', url, '"},{"position":"Lead","tags":["growth"],"date":"2024-01-30 13:00:00","url":"https://r/b', i, '"}]')
    return parsers.remote_jobs(table(spark, sf, "supplier").select("s_suppkey", body.alias("body")), "body", now_col()).select("s_suppkey", "company", "url", "role_family")


@query(
    "model_orgs",
    """WITH s AS (SELECT s_suppkey AS i FROM supplier) SELECT i AS s_suppkey, 'openai' AS slug, 'Openai' AS name, 'https://huggingface.co/openai' AS url FROM s WHERE i % 3 <> 0
    UNION ALL SELECT i, 'my-lab-' || i, 'My Lab ' || i, 'https://huggingface.co/my-lab-' || i FROM s""",
)
def model_orgs(spark, sf):
    i = F.col("s_suppkey")
    body = _text('[{"id":"', F.when(i % 3 == 0, "nope").otherwise("openai/a"), '"},{"modelId":"my-lab-', i, '/b"},{"id":"my-lab-', i, '/c"},{"id":"joe/d"},{"id":"nope"}]')
    return parsers.model_orgs(_payload(spark, sf, body), "body").select("s_suppkey", "slug", "name", "url")


@query(
    "spaces",
    """WITH s AS (SELECT s_suppkey AS i FROM supplier) SELECT i AS s_suppkey, 'My Lab' AS company, 'https://huggingface.co/spaces/my-lab/app' || i AS url, CASE WHEN i % 2 = 0 THEN 'FREE' END AS pricing FROM s
    UNION ALL SELECT i, NULL, 'https://huggingface.co/spaces/solo' || i, NULL FROM s WHERE i % 5 <> 0""",
)
def spaces(spark, sf):
    i = F.col("s_suppkey")
    body = _text('[{"id":"my-lab/app', i, '","tags":["', F.when(i % 2 == 0, "license:mit").otherwise("demo"), '","x"]},{', F.when(i % 5 == 0, "").otherwise(_text('"_id":"solo', i, '",')), '"tags":["y"]},{"tags":[]}]')
    return parsers.spaces(_payload(spark, sf, body), "body").select("s_suppkey", "company", "url", "pricing")


@query(
    "daily_papers",
    """SELECT s_suppkey, 'Paper of ' || s_name AS title, 'Ann;' || s_name AS authors, 'https://arxiv.org/abs/2401.' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS paper_url,
    CASE WHEN s_suppkey % 2 = 0 THEN 'https://github.com/a/b' || s_suppkey END AS github_url, TIMESTAMP '2024-01-02 00:00:00' + (s_suppkey % 24) * INTERVAL 1 HOUR AS published FROM supplier WHERE s_suppkey % 7 <> 0""",
)
def daily_papers(spark, sf):
    i = F.col("s_suppkey")
    paper = F.when(i % 7 == 0, "").otherwise(_text('"id":"2401.', F.lpad(i.cast("string"), 5, "0"), '",'))
    code = F.when(i % 2 == 0, _text("https://github.com/a/b", i)).otherwise("nothing")
    body = _text(
        '[{"paper":{', paper, '"title":"Paper of ', F.col("s_name"), '","authors":[{"name":" Ann "},"', F.col("s_name"), '",{"name":""}],"summary":"see ', code, ' now"},"publishedAt":"2024-01-02T', F.lpad((i % 24).cast("string"), 2, "0"),
        ':00:00Z"},{"paper":{"title":"no id"}}]',
    )
    rows = table(spark, sf, "supplier").select("s_suppkey", body.alias("body"))
    return parsers.daily_papers(rows, "body").select("s_suppkey", "title", F.array_join("authors", ";").alias("authors"), "paper_url", "github_url", "published")


@query(
    "atom_entries",
    """SELECT s_suppkey, 'Big Idea & more ' || s_suppkey AS title, '2301.' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS arxiv_id, 'Ann B;' || s_name AS authors,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'https://github.com/x/y' || s_suppkey END AS github_url, TIMESTAMP '2023-01-02 00:00:00' + (s_suppkey % 28) * INTERVAL 1 DAY AS published FROM supplier""",
)
def atom_entries(spark, sf):
    i = F.col("s_suppkey")
    body = _text(
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2301.', F.lpad(i.cast("string"), 5, "0"), "v2</id><title>Big\n  Idea &amp; more ", i, "</title><author><name> Ann B </name></author><author><name>", F.col("s_name"),
        "</name></author><published>", F.date_format(F.timestamp_seconds(1672617600 + (i % 28) * 86400), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "</published><summary>code: ", F.when(i % 3 != 0, _text("https://github.com/x/y", i, ".")).otherwise("none"),
        "</summary></entry><entry><title>no id</title></entry></feed>",
    )
    rows = table(spark, sf, "supplier").select("s_suppkey", body.alias("body"))
    return parsers.atom_entries(rows, "body").select("s_suppkey", "title", "arxiv_id", F.array_join("authors", ";").alias("authors"), "github_url", "published")


@query(
    "feed_items",
    """WITH s AS (SELECT s_suppkey AS i, s_name AS n FROM supplier) SELECT i AS s_suppkey, 'https://n/' || i AS link, 'News <b> ' || n AS title, 'sum ' || i AS summary FROM s
    UNION ALL SELECT i, 'https://m/' || i, 'Second', '' FROM s WHERE i % 3 = 0""",
)
def feed_items(spark, sf):
    i = F.col("s_suppkey")
    second = F.when(i % 3 == 0, _text("<link>https://m/", i, "</link>")).otherwise("")
    body = _text("<rss><channel><title>x</title><item><title><![CDATA[News <b> ", F.col("s_name"), "]]></title><link>https://n/", i, "</link><pubDate>Tue, 30 Jan 2024 10:00:00 GMT</pubDate><description>sum ", i, "</description></item><item><title>Second</title>", second, "</item></channel></rss>")
    rows = parsers.feed_items(table(spark, sf, "supplier").select("s_suppkey", body.alias("body")), "body")
    return rows.select("s_suppkey", "link", "title", F.coalesce("summary", F.lit("")).alias("summary"))


@query(
    "paper_cards",
    "SELECT s_suppkey, 'Card ' || s_suppkey AS title, 'https://arxiv.org/abs/' || s_suppkey AS paper_url, CASE WHEN s_suppkey % 2 = 0 THEN 'https://github.com/o/r' || s_suppkey END AS github_url FROM supplier WHERE s_suppkey % 5 <> 0",
)
def paper_cards(spark, sf):
    i = F.col("s_suppkey")
    link = F.when(i % 5 == 0, "").otherwise(_text('<a href="https://arxiv.org/abs/', i, '">a</a>'))
    code = F.when(i % 2 == 0, _text('<a href="https://github.com/o/r', i, '">c</a>')).otherwise("")
    body = _text('<div class="row item"><h3> Card ', i, " </h3>", link, code, '</div><div class="item"><h3>no link</h3></div>')
    return parsers.paper_cards(_payload(spark, sf, body), "s_suppkey", "body").select("s_suppkey", "title", "paper_url", "github_url")


@query("html_article_text")
def html_article_text(spark, sf):
    """Main text and excerpt of every page; HTML parsing is beyond SQL."""
    return htmlclean.article_text(table(spark, sf, "pages"), "page_id", "html")


_PLAIN = lambda x: _sql_name(f"strip_accents({x})")
_CLIENTS = f"""WITH seeds AS (SELECT client_id AS ordinal, min(name) AS name, min(email) AS domain FROM clients WHERE client_id = master_id AND name IS NOT NULL GROUP BY client_id),
  al AS (SELECT lower(name) AS alias, arg_max(name, ordinal) AS name, max(ordinal) AS ordinal FROM seeds GROUP BY 1),
  sn AS (SELECT {_PLAIN('alias')} AS norm, arg_max(name, ordinal) AS name FROM al GROUP BY 1),
  dn AS (SELECT lower(domain) AS domain, arg_min(name, ordinal) AS name FROM seeds WHERE domain IS NOT NULL GROUP BY 1),
  ns AS MATERIALIZED (SELECT ordinal, name, {_PLAIN('name')} AS n FROM seeds),
  raw AS MATERIALIZED (SELECT client_id, name AS raw_name, trim(name) AS t, {_PLAIN('trim(name)')} AS norm, lower(replace(email, 'www.', '')) AS domain FROM clients),
  best AS MATERIALIZED (SELECT norm, arg_max(name, row(score, -ordinal)) AS name, max(score) AS score FROM (SELECT norm, name, ordinal, jaro_winkler_similarity(norm, n) AS score FROM (SELECT DISTINCT norm FROM raw WHERE norm <> ''), ns WHERE n <> '') GROUP BY norm),
  j AS (SELECT raw.*, al.name AS a, sn.name AS b, dn.name AS c, best.name AS d, coalesce(best.score, 0) AS score FROM raw LEFT JOIN al ON alias = lower(t) LEFT JOIN sn ON sn.norm = raw.norm AND raw.norm <> '' LEFT JOIN dn ON dn.domain = raw.domain LEFT JOIN best ON best.norm = raw.norm)
  SELECT client_id, raw_name, CASE WHEN coalesce(t, '') = '' THEN NULL WHEN a IS NOT NULL THEN a WHEN b IS NOT NULL THEN b WHEN c IS NOT NULL THEN c WHEN score >= 0.92 THEN d WHEN score >= 0.7 THEN NULL ELSE t END AS canonical,
    CASE WHEN coalesce(t, '') = '' OR a IS NOT NULL THEN 'exact_alias' WHEN b IS NOT NULL THEN 'normalization' WHEN c IS NOT NULL THEN 'context_match' WHEN score >= 0.92 THEN 'fuzzy_match' WHEN score >= 0.7 THEN 'manual_review' ELSE 'exact_alias' END AS method,
    CAST(CASE WHEN coalesce(t, '') = '' THEN 0.0 WHEN a IS NOT NULL THEN 1.0 WHEN b IS NOT NULL THEN 0.98 WHEN c IS NOT NULL THEN 0.95 WHEN score >= 0.7 THEN round(score, 4) ELSE 1.0 END AS DOUBLE) AS confidence,
    CASE WHEN coalesce(t, '') = '' THEN 'REJECTED' WHEN a IS NULL AND b IS NULL AND c IS NULL AND score >= 0.7 AND score < 0.92 THEN 'REVIEW' ELSE 'ACCEPTED' END AS decision FROM j"""


@query("resolve_clients", _CLIENTS)
def resolve_clients(spark, sf):
    """All clients' names against the clients that are their own masters; the address stands for the domain."""
    clients = table(spark, sf, "clients")
    seeds = clients.where("client_id = master_id AND name IS NOT NULL").groupBy("client_id").agg(F.min("name").alias("canonical_name"), F.min("email").alias("domain"))
    seeds = seeds.select(F.col("client_id").alias("ordinal"), "canonical_name", F.lit(None).cast("array<string>").alias("aliases"), "domain")
    found = resolve.resolve(clients.select("client_id", F.col("name").alias("raw_name"), "email"), seeds, domain="email")
    return found.select("client_id", "raw_name", "canonical", "method", "confidence", "decision")


_CLIENT_RECORDS = f"""r AS MATERIALIZED (SELECT client_id AS seq, 'url:' || min(email) AS exact, {_sql_key("strip_accents(coalesce(min(name), ''))")} AS norm, 'STARTUP' AS kind, 'STARTUP:' || substring({_sql_key("strip_accents(coalesce(min(name), ''))")}, 1, 2) AS block FROM clients GROUP BY client_id)"""


@query("client_survivors", _SURVIVORS.replace(_SQL_RECORDS, _CLIENT_RECORDS) + "SELECT o.seq AS client_id, CASE WHEN list_contains(f.kept, o.k) THEN 'keep' ELSE 'duplicate' END AS status FROM o, (SELECT kept FROM s ORDER BY k DESC LIMIT 1) f")
def client_survivors(spark, sf):
    """Clients as records: the first of those with one address or similar names stays."""
    clients = table(spark, sf, "clients").groupBy(F.col("client_id").alias("seq")).agg(F.min("name").alias("name"), F.concat(F.lit("url:"), F.min("email")).alias("exact"))
    plain = F.regexp_replace(text.decomposed(F.col("name")), r"\p{M}", "")
    return dedup.survivors(clients.select("seq", "exact", text.normalize_key(plain).alias("norm"), F.concat(F.lit("STARTUP:"), F.substring(text.normalize_key(plain), 1, 2)).alias("block")), 0.90).select(F.col("seq").alias("client_id"), "status")
