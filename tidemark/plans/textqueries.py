"""Names, addresses and classifiers over the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import classify, text
from tidemark.operators import lookup
from tidemark.plans.registry import query
from tidemark.sources.readers import table

_HOST = r"replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), 'www.', '')"
#: Name variants by key, the same on both sides.
_ENDINGS = ["", " Inc.", " Ltd", " LLC", " Corp.", " Co", " GmbH", " S.A. Labs", " AI Research", "  pvt ltd!"]
_VARIANT = "p_name || [" + ", ".join(f"'{e}'" for e in _ENDINGS) + "][CAST(p_partkey % 10 AS INT) + 1]"


def _names(spark, sf):
    ending = F.element_at(F.array(*map(F.lit, _ENDINGS)), (F.col("p_partkey") % 10 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", F.concat("p_name", ending).alias("name"))


def _sql_key(x: str) -> str:
    out = f"lower({x})"
    for ending in text.LEGAL_ENDINGS:
        out = f"regexp_replace({out}, '{ending}', '', 'g')"
    return rf"trim(regexp_replace(regexp_replace({out}, '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '\s+', ' ', 'g'))"


def _sql_name(x: str) -> str:
    out = rf"regexp_replace(replace(lower({x}), '.', ''), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({out}, '{text.IGNORED_WORDS}', ' ', 'g'), '\s+', ' ', 'g'))"


@query("url_netloc", f"SELECT page_id, {_HOST} AS host FROM pages")
def url_netloc(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.netloc(F.col("url")).alias("host"))


@query("normalize_key", f"SELECT p_partkey, {_sql_key(_VARIANT)} AS key FROM part")
def normalize_key(spark, sf):
    return _names(spark, sf).select("p_partkey", text.normalize_key(F.col("name")).alias("key"))


@query("normalize_name", f"SELECT p_partkey, {_sql_name(_VARIANT)} AS key FROM part")
def normalize_name(spark, sf):
    return _names(spark, sf).select("p_partkey", text.normalize_name(F.col("name")).alias("key"))


@query("block_key", f"SELECT p_partkey, 'STARTUP:' || substring({_sql_key(_VARIANT)}, 1, 2) AS block FROM part")
def block_key(spark, sf):
    return _names(spark, sf).select("p_partkey", text.block_key(F.col("name"), F.lit("STARTUP")).alias("block"))


_KINDS = "['STARTUP', 'PRODUCT', 'RESEARCH_PAPER', 'JOB', 'NEWS', 'OTHER']"


@query(
    "exact_key",
    f"""WITH r AS (SELECT page_id, {_KINDS}[CAST(page_id % 6 AS INT) + 1] AS kind, CASE WHEN page_id % 11 = 0 THEN '' WHEN page_id % 13 = 0 THEN 'https://github.com/a/b' || page_id ELSE url END AS url, CASE WHEN page_id % 4 = 0 THEN '2301.' || page_id END AS arxiv FROM pages),
    h AS (SELECT *, {_HOST} AS host FROM r)
    SELECT page_id, CASE kind WHEN 'RESEARCH_PAPER' THEN CASE WHEN arxiv IS NOT NULL THEN 'arxiv:' || arxiv WHEN url <> '' THEN 'url:' || url END
      WHEN 'STARTUP' THEN CASE WHEN url <> '' AND host <> '' AND host NOT IN ('huggingface.co', 'github.com', 'raw.githubusercontent.com', 'thataicollection.com') THEN 'startup_domain:' || host WHEN url <> '' AND host <> '' THEN 'startup_url:' || url ELSE 'startup_name:acme ' || page_id END
      WHEN 'OTHER' THEN NULL ELSE CASE WHEN url <> '' THEN 'url:' || url END END AS key FROM h""",
)
def exact_key(spark, sf):
    kinds = F.array(*map(F.lit, ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS", "OTHER"]))
    i = F.col("page_id")
    url = F.when(i % 11 == 0, "").when(i % 13 == 0, F.concat(F.lit("https://github.com/a/b"), i)).otherwise(F.col("url"))
    rows = table(spark, sf, "pages").select("page_id", F.element_at(kinds, (i % 6 + 1).cast("int")).alias("kind"), url.alias("url"), F.when(i % 4 == 0, F.concat(F.lit("2301."), i)).alias("arxiv"), F.concat(F.lit("Acme "), i).alias("name"))
    return rows.select("page_id", text.exact_key(F.col("kind"), F.col("url"), F.col("name"), F.col("arxiv"), F.col("url")).alias("key"))


@query("content_hash", "SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query(
    "excerpt",
    """WITH p AS (SELECT doc_id, string_split(text, chr(10) || chr(10))[1] AS f, text FROM documents), c AS (SELECT *, substring(f, 1, 350) AS t FROM p), s AS (SELECT *, length(t) - coalesce(nullif(strpos(reverse(t), ' '), 0), length(t) + 1) AS sp FROM c)
    SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN '' WHEN length(f) <= 350 THEN f WHEN sp > 200 THEN substring(t, 1, sp) || '...' ELSE t || '...' END AS excerpt FROM s""",
)
def excerpt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


_REPOS = ["https://github.com/owner/repo.git", "see github.com/a-b/digit?x=1", "https://github.com/topics/ml", "https://gitlab.com/x/y", "http://github.com/Org/Name/tree/main", "https://github.com/solo"]
_REPO_SQL = "[" + ", ".join(f"'{r}'" for r in _REPOS) + "][CAST(p_partkey % 6 AS INT) + 1] || CASE WHEN p_partkey % 6 = 5 THEN '' ELSE '' END"


@query(
    "github_repo",
    rf"""WITH r AS (SELECT p_partkey, {_REPO_SQL} AS u FROM part), m AS (SELECT *, regexp_extract(u, 'github\.com/([^/]+)/([^/\s#?.]+)', 1) AS o, rtrim(regexp_extract(u, 'github\.com/([^/]+)/([^/\s#?.]+)', 2), '.git') AS n FROM r)
    SELECT p_partkey, CASE WHEN o <> '' AND lower(o) NOT IN ('topics', 'explore', 'settings', 'notifications') THEN o || '/' || n END AS repo FROM m""",
)
def github_repo(spark, sf):
    url = F.element_at(F.array(*map(F.lit, _REPOS)), (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", text.github_repo(url).alias("repo"))


@query(
    "arxiv_id",
    r"""WITH u AS (SELECT p_partkey, 'http://arxiv.org/abs/' || CASE WHEN p_partkey % 3 = 0 THEN 'cs/' || p_partkey ELSE '2301.' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') || CASE WHEN p_partkey % 3 = 1 THEN 'v2' ELSE '' END END AS u FROM part)
    SELECT p_partkey, coalesce(nullif(regexp_extract(u, '(\d{4}\.\d{4,5})(v\d+)?$', 1), ''), u) AS arxiv_id FROM u""",
)
def arxiv_id(spark, sf):
    i = F.col("p_partkey")
    number = F.concat(F.lit("2301."), F.lpad(i.cast("string"), 5, "0"), F.when(i % 3 == 1, "v2").otherwise(""))
    url = F.concat(F.lit("http://arxiv.org/abs/"), F.when(i % 3 == 0, F.concat(F.lit("cs/"), i)).otherwise(number))
    return table(spark, sf, "part").select("p_partkey", text.arxiv_id(url).alias("arxiv_id"))


@query("display_name", "SELECT s_suppkey, 'Open Lab ' || s_suppkey AS name FROM supplier")
def display_name(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", text.display_name(F.concat(F.lit("open-lab-"), "s_suppkey")).alias("name"))


@query("collapse_space", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def collapse_space(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.collapse(F.col("text")).alias("text"))


_TITLES = [
    "Senior Product Manager", "UI/UX Designer (remote)", "Research Scientist, Alignment", "Data Analyst", "Account Executive - Anywhere", "Growth Lead", "Legal Counsel", "Backend Engineer", "Chief of Staff",
    "Distributed Systems Engineer", "Content Designer", "Head of Product, PM team",
]


def _cases(words_by_value: dict[str, list[str]], column: str) -> str:
    test = lambda words: " OR ".join(f"contains(lower({column}), '{w}')" for w in words)
    return " ".join(f"WHEN {test(words)} THEN '{value}'" for value, words in words_by_value.items())


_TITLE_SQL = "[" + ", ".join(f"'{t}'" for t in _TITLES) + "][CAST(c_custkey % 12 AS INT) + 1]"


def _titles(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.element_at(F.array(*map(F.lit, _TITLES)), (F.col("c_custkey") % 12 + 1).cast("int")).alias("title"))


@query("role_family", f"SELECT c_custkey, CASE {_cases(classify.ROLE_FAMILIES, 'title')} ELSE 'ENGINEERING' END AS role_family FROM (SELECT c_custkey, {_TITLE_SQL} AS title FROM customer)")
def role_family(spark, sf):
    return _titles(spark, sf).select("c_custkey", classify.role_family(F.col("title")).alias("role_family"))


@query("remote_flag", rf"SELECT c_custkey, regexp_matches({_TITLE_SQL}, '(?i)\b(remote|anywhere|wfh|telecommute|distributed)\b') AS is_remote FROM customer")
def remote_flag(spark, sf):
    return _titles(spark, sf).select("c_custkey", classify.is_remote(F.col("title")).alias("is_remote"))


_OFFERS = ["Open source, MIT license", "Freemium with free tier", "free credits to start", "Contact sales for pricing", "only $9 a month", "nothing said", "free tier with paid upgrade", "per seat license", "demo upon request"]
_OFFER_SQL = "[" + ", ".join(f"'{t}'" for t in _OFFERS) + "][CAST(c_custkey % 9 AS INT) + 1]"


@query(
    "pricing",
    f"""SELECT c_custkey, CASE WHEN {' OR '.join(f"contains(lower(t), '{w}')" for w in classify.FREE)} THEN CASE {_cases({'FREEMIUM': classify.FREE_THEN_PAID}, 't')} ELSE 'FREE' END
    {_cases({'FREEMIUM': classify.FREEMIUM, 'ENTERPRISE': classify.ENTERPRISE, 'PAID': classify.PAID}, 't')} END AS pricing FROM (SELECT c_custkey, {_OFFER_SQL} AS t FROM customer)""",
)
def pricing(spark, sf):
    offer = F.element_at(F.array(*map(F.lit, _OFFERS)), (F.col("c_custkey") % 9 + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", classify.pricing(offer).alias("pricing"))


_SLUGS = ["openai", "john-doe", "deep-thing", "my-lab", "x-llm-y", "fooai", "researcher", "acme-labs", "data-nerd", "someone"]


@query(
    "org_filter",
    f"""SELECT s_suppkey, slug, slug IN ({', '.join(f"'{k}'" for k in classify.KNOWN_ORGS)}) OR regexp_matches(slug, '-(?:{'|'.join(classify.ORG_PARTS)})$|^(?:{'|'.join(classify.ORG_PARTS)})-|-(?:{'|'.join(classify.ORG_PARTS)})-|(?:{'|'.join(classify.ORG_ENDINGS)})$') AS is_org
    FROM (SELECT s_suppkey, [{', '.join(f"'{s}'" for s in _SLUGS)}][CAST(s_suppkey % 10 AS INT) + 1] AS slug FROM supplier)""",
)
def org_filter(spark, sf):
    slug = F.element_at(F.array(*map(F.lit, _SLUGS)), (F.col("s_suppkey") % 10 + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", slug.alias("slug")).withColumn("is_org", classify.is_org(F.col("slug")))


_NEWS = "text || [' OpenAI and xAI met Groq', ' openai', ' Meta AIs', ' Apple; NVIDIA!', ''][CAST(doc_id % 5 AS INT) + 1]"


@query("mentions", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"'{e}'" for e in classify.KNOWN_ENTITIES) + rf"], lambda e: regexp_matches({_NEWS}, '(?i)\b' || e || '\b')), ';') AS entities FROM documents")
def mentions(spark, sf):
    tail = F.element_at(F.array(*map(F.lit, [" OpenAI and xAI met Groq", " openai", " Meta AIs", " Apple; NVIDIA!", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(classify.mentions(F.concat("text", tail)), ";").alias("entities"))


@query("mentions_lookup", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"'{e}'" for e in classify.KNOWN_ENTITIES) + rf"], lambda e: regexp_matches({_NEWS}, '(?i)\b' || e || '\b')), ';') AS entities FROM documents")
def mentions_lookup(spark, sf):
    """As mentions, from a table of entities and one pass over the texts."""
    tail = F.element_at(F.array(*map(F.lit, [" OpenAI and xAI met Groq", " openai", " Meta AIs", " Apple; NVIDIA!", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    names = spark.createDataFrame(list(enumerate(classify.KNOWN_ENTITIES)), "ordinal int, name string")
    docs = table(spark, sf, "documents").select("doc_id", F.concat("text", tail).alias("text"))
    order = F.array(*map(F.lit, classify.KNOWN_ENTITIES))
    named = F.transform("mentioned", lambda i: F.element_at(order, (i + 1).cast("int")))
    return lookup.mentions(docs, "text", names).select("doc_id", F.array_join(named, ";").alias("entities"))


_SIGNS = ["<p>ok</p>", "Just a moment...", "g-recaptcha box", "<div class=h-captcha>", "cf-turnstile", "DataDome here", "Access Denied"]
_SIGN_SQL = "html || [" + ", ".join(f"'{s}'" for s in _SIGNS) + "][CAST(page_id % 7 AS INT) + 1]"


def _signs(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.concat("html", F.element_at(F.array(*map(F.lit, _SIGNS)), (F.col("page_id") % 7 + 1).cast("int"))).alias("html"))


@query("challenge_page", f"SELECT page_id, {' OR '.join(f'contains(h, {chr(39)}{s}{chr(39)})' for s in classify.CHALLENGE_SIGNS)} AS challenge FROM (SELECT page_id, lower({_SIGN_SQL}) AS h FROM pages)")
def challenge_page(spark, sf):
    return _signs(spark, sf).select("page_id", classify.is_challenge(F.col("html")).alias("challenge"))


@query(
    "captcha_type",
    f"""SELECT page_id, CASE WHEN contains(h, 'recaptcha') THEN 'reCAPTCHA' WHEN contains(h, 'hcaptcha') OR contains(h, 'h-captcha') THEN 'hCaptcha' WHEN contains(h, 'cf-turnstile') THEN 'Cloudflare Turnstile' WHEN contains(h, 'datadome') THEN 'DataDome' END AS captcha
    FROM (SELECT page_id, lower({_SIGN_SQL}) AS h FROM pages)""",
)
def captcha_type(spark, sf):
    return _signs(spark, sf).select("page_id", classify.captcha(F.col("html")).alias("captcha"))


_TAGS = ["license:mit", "license:gpl", "license:other", "en"]


@query("license_pricing", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 IN (0, 1) OR (s_suppkey + 1) % 4 IN (0, 1) THEN 'FREE' END AS pricing FROM supplier")
def license_pricing(spark, sf):
    tag = lambda n: F.element_at(F.array(*map(F.lit, _TAGS)), ((F.col("s_suppkey") + n) % 4 + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", classify.license_pricing(F.array(tag(0), tag(1))).alias("pricing"))


_HOSTS = ["api.openai.com", "x.ai", "maps.google.com", "example.com", "deepmind.google", "notgoogle.com"]


@query(
    "domain_company",
    "SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'OpenAI' WHEN 1 THEN 'xAI' WHEN 2 THEN 'Google' WHEN 4 THEN 'Google DeepMind' END AS company FROM supplier",
)
def domain_company(spark, sf):
    host = F.element_at(F.array(*map(F.lit, _HOSTS)), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", classify.host_company(host).alias("company"))


@query(
    "host_lookup",
    f"""WITH t(host, company, ordinal) AS (VALUES {", ".join(f"('{h}', '{n}', {i})" for i, (h, n) in enumerate(classify.HOST_COMPANIES.items()))}),
    u AS (SELECT c_custkey, ['', 'www.', 'a.b.', 'not', 'docs.'][CAST(c_custkey % 5 AS INT) + 1] || (SELECT host FROM t WHERE ordinal = c_custkey % 16) || CASE WHEN c_custkey % 11 = 0 THEN '.org' ELSE '' END AS host FROM customer)
    SELECT c_custkey, arg_min(company, ordinal) AS company FROM u LEFT JOIN t ON u.host = t.host OR ends_with(u.host, '.' || t.host) GROUP BY c_custkey""",
)
def host_lookup(spark, sf):
    """Companies of hosts and their parents, from a table of hosts."""
    known = spark.createDataFrame([(h, n, i) for i, (h, n) in enumerate(classify.HOST_COMPANIES.items())], "host string, company string, ordinal int")
    i, pick = F.col("c_custkey"), lambda values, n: F.element_at(F.array(*map(F.lit, values)), (F.col("c_custkey") % n + 1).cast("int"))
    host = F.concat(pick(["", "www.", "a.b.", "not", "docs."], 5), pick(list(classify.HOST_COMPANIES), 16), F.when(i % 11 == 0, ".org").otherwise(""))
    return lookup.by_host(table(spark, sf, "customer").select(i, host.alias("at")), "at", known).select("c_custkey", "company")


_BLURBS = ["A chat tool by Acme Labs, for all", "Built from scratch and text input (fast)", "OpenAI's model", "plain words", "created by Tiny Corp. Nice"]


@query("parent_company", "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'Acme Labs' WHEN 1 THEN 'Cohere' WHEN 2 THEN 'OpenAI' WHEN 3 THEN 'Cohere' WHEN 4 THEN 'Tiny Corp' END AS company FROM supplier")
def parent_company(spark, sf):
    blurb = F.element_at(F.array(*map(F.lit, _BLURBS)), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return table(spark, sf, "supplier").select("s_suppkey", classify.maker(blurb, F.lit("docs.cohere.com")).alias("company"))


@query(
    "name_filters",
    f"""SELECT p_partkey, length(n) BETWEEN 2 AND 50 AND NOT starts_with(n, '!') AND NOT ({' OR '.join(f"contains(lower(n), '{w}')" for w in classify.NO_STARTUP_NAMES)}) AS good
    FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Demo ' || p_name WHEN 1 THEN '!' || p_name WHEN 2 THEN 'x' WHEN 3 THEN repeat(p_name, 9) ELSE p_name END AS n FROM part)""",
)
def name_filters(spark, sf):
    i, name = F.col("p_partkey") % 6, F.col("p_name")
    made = F.when(i == 0, F.concat(F.lit("Demo "), name)).when(i == 1, F.concat(F.lit("!"), name)).when(i == 2, "x").when(i == 3, F.repeat(name, 9)).otherwise(name)
    return table(spark, sf, "part").select("p_partkey", classify.good_name(made, classify.NO_STARTUP_NAMES).alias("good"))
