import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import classify, dates, scoring, text


def now():
    return F.lit("2024-06-15 12:00:00").cast("timestamp_ntz")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "name,key",
    [("OpenAI", "openai"), ("OPENAI Inc.", "openai"), ("Acme Pvt Ltd", "acme"), ("Café", "cafe"), ("a   b", "a b"), ("", ""), ("Inc.", ""), ("X-Ray LLC!", "x-ray")],
)
def test_normalize_key(spark, name, key):
    assert one(spark, text.normalize_key(F.lit(name))) == key


@pytest.mark.parametrize("name,key", [("Mistral AI S.A.S.", "mistral"), ("OpenAI, Inc.", "openai"), ("Déjà Labs", "deja"), ("Weights & Biases", "weights biases"), (None, "")])
def test_normalize_name(spark, name, key):
    assert one(spark, text.normalize_name(F.lit(name).cast("string"))) == key


def test_jaro_winkler_like_duckdb():
    names = ["openai", "open ai", "stabilityai", "stability", "anthropic", "a", "", "mistral", "mistrall", "martha", "marhta", "dixon", "dicksonx"]
    for a in names:
        for b in names:
            if a and b:
                expected = duckdb.sql(f"select jaro_winkler_similarity('{a}', '{b}')").fetchall()[0][0]
                assert abs(text._jaro_winkler(a, b) - expected) < 1e-9, (a, b)


@pytest.mark.parametrize(
    "url,host,repo",
    [
        ("https://www.OpenAI.com/x", "openai.com", None),
        ("http://u@h.com:80/www.", "u@h.com:80", None),
        ("https://github.com/a/digit.git", "github.com", "a/d"),
        ("https://github.com/Topics/ml", "github.com", None),
        ("nonsense", "", None),
    ],
)
def test_addresses(spark, url, host, repo):
    row = spark.range(1).select(text.netloc(F.lit(url)).alias("h"), text.github_repo(F.lit(url)).alias("r")).first()
    assert (row.h, row.r) == (host, repo)


def test_excerpt(spark):
    assert one(spark, text.excerpt(F.lit("short\n\nmore"))) == "short"
    assert one(spark, text.excerpt(F.lit("word " * 100))) == "word " * 69 + "word..."
    assert one(spark, text.excerpt(F.lit("x" * 400))) == "x" * 350 + "..."
    assert one(spark, text.excerpt(F.lit(""))) == ""


@pytest.mark.parametrize(
    "value,expected",
    [
        ("2024-05-01T10:00:00+05:30", "2024-05-01 04:30:00"),
        ("2024-05-01T10:00:00-07:00", "2024-05-01 17:00:00"),
        ("2024-05-01T10:00:00Z", "2024-05-01 10:00:00"),
        ("2024-05-01T10:00:00.123456Z", "2024-05-01 10:00:00.123456"),
        ("2024-05-01", "2024-05-01 00:00:00"),
        ("Wed, 01 May 2024 10:00:00 GMT", "2024-05-01 10:00:00"),
        ("Wed, 01 May 2024 10:00:00 +0200", "2024-05-01 08:00:00"),
        ("2024/05/01 01:02:03", "2024-05-01 01:02:03"),
        ("", None),
        ("garbage", None),
        ("2024-13-45", None),
        ("12:30", None),
    ],
)
def test_parse_utc(spark, value, expected):
    got = one(spark, dates.parse_utc(F.lit(value)))
    assert (str(got) if got else None) == expected


@pytest.mark.parametrize(
    "value,label,at",
    [
        ("posted just now", "relative_text:just_now", "2024-06-15 12:00:00"),
        ("Yesterday", "relative_text:yesterday", "2024-06-14 12:00:00"),
        ("45 minutes ago", "relative_text:45_minutes_ago", "2024-06-15 11:15:00"),
        ("1 week ago", "relative_text:1_weeks_ago", "2024-06-08 12:00:00"),
        ("nothing", None, None),
    ],
)
def test_relative(spark, value, label, at):
    row = spark.range(1).select(dates.relative(F.lit(value), now()).alias("d")).select("d.label", "d.at").first()
    assert (row.label, str(row.at) if row.at else None) == (label, at)


def test_waterfall_order(spark):
    ld = '<script type="application/ld+json">{"@graph":[{"datePublished":"2024-01-01"}]}</script>'
    meta = "<meta property='og:published_time' content='2024-02-02'>"
    tag = '<time datetime="2024-03-03">'
    ago = "<p>2 hours ago</p>"
    cases = [(ld + meta + tag + ago, "json_ld:datePublished"), (meta + tag + ago, "og:published_time"), (tag + ago, "html5:time_element"), (ago, "relative_text:2_hours_ago"), ("<p>x", "feed_metadata")]
    for page, label in cases:
        row = spark.range(1).select(dates.waterfall(F.lit(page), F.lit("Mon, 01 Jan 2024 00:00:00 GMT"), F.lit("2024-01-01"), now()).alias("d")).select("d.label").first()
        assert row.label == label
    none = F.lit(None).cast("string")
    assert spark.range(1).select(dates.waterfall(none, none, none, now()).alias("d")).select("d.at").first().at is None


def test_freshness(spark):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    got = [one(spark, dates.is_fresh(at(s), now())) for s in ("2024-06-15 07:30:00", "2024-06-14 11:00:00", None, "2024-06-15 14:00:00", "2024-06-15 12:03:00")]
    assert got == [True, False, False, False, False]


def test_classifiers(spark):
    titles = {"Product Manager": "PRODUCT", "UI/UX person": "DESIGN", "Research Scientist": "RESEARCH", "BI Analyst": "DATA", "SDR": "SALES", "DevRel": "MARKETING", "Chrome team": "OPERATIONS", "Go Developer": "ENGINEERING", "x": "ENGINEERING"}
    for title, family in titles.items():
        assert one(spark, classify.role_family(F.lit(title))) == family
    prices = {"open source and freemium": "FREEMIUM", "MIT License": "FREE", "free credits": "FREEMIUM", "custom quote": "ENTERPRISE", "$5": "PAID", "unknown": None}
    for words, price in prices.items():
        assert one(spark, classify.pricing(F.lit(words))) == price
    assert one(spark, classify.is_remote(F.lit("Work from Anywhere"))) and not one(spark, classify.is_remote(F.lit("remotely")))
    assert one(spark, classify.mentions(F.lit("openai met xAI"))) == ["OpenAI", "xAI"]
    assert [one(spark, classify.captcha(F.lit(x))) for x in ("G-RECAPTCHA", "h-captcha", "cf-turnstile", "DataDome", "ok")] == ["reCAPTCHA", "hCaptcha", "Cloudflare Turnstile", "DataDome", None]
    assert one(spark, classify.is_challenge(F.lit("Just a Moment..."))) and not one(spark, classify.is_challenge(F.lit("")))


def test_scores(spark):
    def total(**k):
        args = {"url": F.lit("https://arxiv.org/x"), "published": now(), "collected": now(), "corroborated": F.lit(True), "disputed": F.lit(False), "method": F.lit("api_structured"), "incomplete": F.lit(False), "now": now()} | k
        return one(spark, scoring.breakdown(**args)["total"])

    assert total() == 100.0
    assert total(disputed=F.lit(True)) == 75.0
    assert total(corroborated=F.lit(False), url=F.lit("https://x.com"), method=F.lit("?"), incomplete=F.lit(True)) == 0.3 * 70 + 0.25 * 50 + 25 + 0.2 * 70
