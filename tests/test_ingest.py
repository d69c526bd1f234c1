"""News records, routing, enrichment and what leaves the engine, case by case."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest, news

NOW = "2024-01-31 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


LONG = "<html><body><div><p>" + "A long enough paragraph of an article about OpenAI. " * 4 + "</p></div></body></html>"


@pytest.mark.parametrize(
    "feed,html,expected",
    [
        ("Feed", "<h1>x</h1>", "Feed"),
        ("", "<title>t</title><H1 class='a'> A <b>bold</b> &amp; more </H1>", "A bold & more"),
        (None, "<h1> </h1><title>\n T </title>", "T"),
        ("", "<h1></h1>", "Untitled AI Article"),
        (None, None, "Untitled AI Article"),
    ],
)
def test_title(spark, feed, html, expected):
    df = spark.createDataFrame([(feed, html)], "f string, h string")
    assert df.select(news.title_of(F.col("f"), F.col("h")).alias("t")).first().t == expected


@pytest.mark.parametrize("text,summary,expected", [("x" * 80, "s", "x" * 80), ("short", "s", "s"), ("short", None, "short"), ("short", "", None), ("", None, None), (None, "s", "s"), (None, None, None)])
def test_body(spark, text, summary, expected):
    df = spark.createDataFrame([(text, summary)], "t string, s string")
    assert df.select(news.body_of(F.col("t"), F.col("s")).alias("b")).first().b == expected


def test_news_records(spark):
    at = {"fresh": "Tue, 30 Jan 2024 22:00:00 GMT", "old": "Mon, 29 Jan 2024 18:00:00 GMT"}
    pages = [("u1", LONG, "S", None), ("u2", LONG, "S", None), ("u3", LONG, "S", None), ("u4", LONG, "S", at["fresh"]), ("u5", "<p>x</p>", "S", None), ("not a url", LONG, "S", at["fresh"])]
    pages = [(u if " " in u else f"https://n.example.com/{u}", *rest) for u, *rest in pages]
    feed = [("u1", 2, "Later", "later", at["fresh"], "s"), ("u1", 1, "Feed", "First", at["fresh"], "s"), ("u2", 3, "Feed", "Old", at["old"], "s"), ("u5", 4, "Feed", "Short", at["fresh"], "The summary.")]
    feed = [(f"https://n.example.com/{u}", *rest) for u, *rest in feed]
    made = news.news_records(spark.createDataFrame(pages, "url string, html string, source_name string, last_modified string"), spark.createDataFrame(feed, "url string, seq int, source_name string, title string, published string, summary string"), now())
    got = {r.url.rpartition("/")[2]: r for r in made.collect()}
    assert set(got) == {"u1", "u4", "u5", "not a url"}  # one is stale, one has no date
    assert got["u1"].status == "PASSED" and got["u1"].age_hours == 2.0 and got["u1"].date_method == "feed_metadata"
    record = json.loads(got["u1"].record)
    assert record["source"] == {"name": "Feed", "url": "https://n.example.com/u1"} and record["content"]["title"] == "First" and record["content"]["mentionedEntities"] == ["OpenAI"]
    assert json.loads(got["u4"].record)["source"]["name"] == "S" and got["u4"].title == "Untitled AI Article"
    assert json.loads(got["u5"].record)["content"]["fullText"] == "The summary."
    assert got["not a url"].status == "FAILED" and got["not a url"].violations == ["source.url: not a URL"]


def test_routing_takes_the_first_route(spark):
    df = spark.createDataFrame([(1, "https://a/x/y", "p1"), (2, "https://b/y", "p2"), (3, "https://c", "p3"), (4, None, "p4")], "k int, source_url string, body string")
    parser = lambda tag: lambda d: d.select("k", "source_url", F.concat(F.lit(tag), "body").alias("n"))
    routes = [("/x/", parser("one:"), {"name": F.col("n"), "record_type": F.lit("A")}), ("/y", parser("two:"), {"name": F.col("n")})]
    got = {r.k: (r.record_type, r.name, r.url) for r in ingest.routed(df, routes, keys=("k",)).collect()}
    assert got == {1: ("A", "one:p1", None), 2: (None, "two:p2", None)}


def test_enrichment_and_inspection(spark):
    good = '{"source":{"name":"n","url":"https://x.com"},"content":{"entityName":"E"},"collectedAt":"2024-01-01"}'
    row = ("STARTUP", "https://x.com/1", good, None, None, True, False, "html_parsing", False)
    rows = [row, ("STARTUP", "https://x.com/2", "{}", *row[3:])]
    df = spark.createDataFrame(rows, "record_type string, source_url string, json string, published timestamp_ntz, collected timestamp_ntz, corroborated boolean, disputed boolean, method string, incomplete boolean")
    got = {r.source_url: r for r in ingest.enrich(df, "run", now()).collect()}
    assert got["https://x.com/1"].validation_status == "PASSED" and got["https://x.com/2"].validation_status == "FAILED"
    assert len({r.id for r in got.values()} | {r.lineage_chain_id for r in got.values()}) == 4
    assert got["https://x.com/1"].quality_score == got["https://x.com/1"].quality_breakdown.total
    shown = ingest.inspect(ingest.enrich(df, "run", now()), F.col("source_url") == "https://x.com/2").collect()
    assert len(shown) == 1 and json.loads(shown[0].record)["violations"] and "\n" in shown[0].record and json.loads(shown[0].record)["published"] is None


def test_small_joins(spark, tmp_path):
    config = spark.createDataFrame([("a", "Acme")], "api_url string, company string")
    assert [tuple(r) for r in ingest.with_config(spark.createDataFrame([("a", 1), ("b", 2)], "source_url string, k int"), config).collect()] == [("a", 1, "Acme")]
    papers = spark.createDataFrame([("1",), ("2",), (None,)], "arxiv_id string")
    got = {r.arxiv_id: r.authors for r in ingest.with_authors(papers, spark.createDataFrame([("1", ["A"])], "arxiv_id string, authors array<string>")).collect()}
    assert got == {"1": ["A"], "2": [], None: []}
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("soon",), (None,)], "t string").select(ingest.paper_date(F.col("t"), now()).alias("at"))
    assert [str(r.at) for r in df.collect()] == ["2024-01-02 03:04:05", NOW, NOW]
    ingest.write_json(spark.createDataFrame([(1, None, "x")], "a int, b string, _c string"), str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first().value) == {"a": 1, "b": None}


def test_chunks(spark):
    text = "\n\n".join(["a" * 30, "b" * 30, "", "c" * 200, "d"])
    df = spark.createDataFrame([(1, text), (1, "x"), (2, None), (3, "")], "k int, t string")
    got = sorted((r.k, r.chunk, r.text) for r in ingest.chunks(df, "k", "t", 50).collect())
    assert got == [(1, 0, "a" * 30 + "\n\n" + "b" * 30), (1, 0, "x"), (1, 1, "c" * 200), (1, 5, "d")]


def test_settled(spark):
    from tidemark.sources import crawl

    rows = [("a", 0, 503, None, "x"), ("a", 1, 429, "7", "x"), ("a", 2, 200, None, "good"), ("a", 3, 200, None, "late"), ("b", 0, 413, None, "x"), ("c", 0, None, None, None), ("d", 0, 404, None, "x")]
    rows += [("e", k, 500, None, "x") for k in range(5)] + [("f", 0, 429, " soon", "x"), ("f", 1, 200, None, "good")]
    got = {r.url: (r.outcome, r.attempts, r.waited, r.raw_content) for r in crawl.settled(spark.createDataFrame(rows, "url string, attempt int, http_status int, retry_after string, raw_content string")).collect()}
    assert got == {"a": ("ok", 3, 8.0, "good"), "b": ("too_large", 1, 0.0, None), "c": ("unfinished", 1, 1.0, None), "d": ("refused", 1, 0.0, None), "e": ("exhausted", 4, 15.0, None), "f": ("ok", 2, 1.0, "good")}


def test_pacing_like_a_token_bucket(spark):
    import random

    from tidemark.sources import crawl

    rng = random.Random(2)
    rows = [(f"https://d{rng.randrange(3)}.com/{i:04d}", rng.randrange(60)) for i in range(150)]
    got = {r.url: r.start for r in crawl.paced(spark.createDataFrame(rows, "url string, at int"), rate=0.5, burst=4).collect()}
    for d in range(3):
        tokens, last = 4.0, None
        for url, at in sorted((r for r in rows if f"d{d}." in r[0]), key=lambda r: (r[1], r[0])):
            now = at if last is None else max(at, last)
            tokens = min(4.0, tokens + (0 if last is None else (now - last) * 0.5))
            if tokens < 1:
                now, tokens = now + (1 - tokens) / 0.5, 1.0
            tokens, last = tokens - 1, now
            assert abs(got[url] - now) < 1e-9


def test_titles_decode_what_their_sql_decodes(spark, tmp_path):
    import duckdb

    from tidemark.plans import catalog

    rows = [(0, "https://a.com", "<h1>a &quot;b&quot; &lt;c &amp;amp;</h1>"), (1, "https://b.com", "<title>&#39;t&#39;&nbsp;&amp;</title>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = dict(con.execute(catalog.oracle_sql()["title_fallback"]).fetchall())
    assert {r.page_id: r.title for r in catalog.queries()["title_fallback"](spark, str(tmp_path)).collect()} == want
    full = spark.createDataFrame(rows, "page_id long, url string, html string").select(news.title_of(F.lit(""), F.col("html")).alias("t"))
    assert [r.t for r in full.collect()] == ['a "b" <c &amp;', "'t' &"]
