import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import dedup, htmlclean, incremental, lineage, metrics, resolve, search, verify
from tidemark.sources import parsers, readers, sinks


def now():
    return F.lit("2024-06-15 12:00:00").cast("timestamp_ntz")


def brute_survivors(rows, threshold):
    kept, status = [], {}
    for seq, exact, norm, block in sorted(rows):
        twin = any(
            (exact is not None and exact == e) or (block.split(":")[0] == b.split(":")[0] and norm == n) or (block == b and norm and n and text._jaro_winkler(norm, n) >= threshold) for _, e, n, b in kept
        )
        status[seq] = "duplicate" if twin else "keep"
        if not twin:
            kept.append((seq, exact, norm, block))
    return status


@pytest.mark.parametrize("seed", [1, 2])
def test_survivors(spark, seed):
    rng = random.Random(seed)
    names = ["acme", "acmee", "acmes", "acne", "abcde", "abcdf", "abxdf", "zeta", "zetas", ""]
    rows = []
    for i in range(60):
        n = rng.choice(names)
        kind = rng.choice("AB")
        rows.append((i, rng.choice([None, f"u{rng.randrange(25)}"]), n, f"{kind}:{n[:2]}"))
    df = spark.createDataFrame(rows, "seq long, exact string, norm string, block string")
    got = {r.seq: r.status for r in dedup.survivors(df, 0.85).collect()}
    assert got == brute_survivors(rows, 0.85)


def test_resolver(spark, tmp_path):
    (tmp_path / "seed.json").write_text('{"entities": [{"canonical_name": "OpenAI", "aliases": ["Open AI"], "domain": "openai.com", "category": "x"}, {"canonical_name": "Mistral AI", "aliases": ["mistralai"], "domain": "mistral.ai", "category": "x"}]}')
    seeds = readers.seeds(spark, str(tmp_path / "seed.json"))
    raw = spark.createDataFrame([("open ai", None), ("Mistral AI S.A.S.", None), ("Unknown", "www.openai.com"), ("Mistrals", None), ("Mistworld", None), ("Brand New", None), (" ", None)], "raw_name string, domain string")
    got = {r.raw_name: (r.canonical, r.method, r.decision) for r in resolve.resolve(raw, seeds, domain="domain").collect()}
    assert got["open ai"] == ("OpenAI", "exact_alias", "ACCEPTED")
    assert got["Mistral AI S.A.S."] == ("Mistral AI", "normalization", "ACCEPTED")
    assert got["Unknown"] == ("OpenAI", "context_match", "ACCEPTED")
    assert got["Mistrals"] == ("Mistral AI", "fuzzy_match", "ACCEPTED")
    assert got["Mistworld"][0] is None and got["Mistworld"][1:] == ("manual_review", "REVIEW")
    assert got["Brand New"] == ("Brand New", "exact_alias", "ACCEPTED")
    assert got[" "] == (None, "exact_alias", "REJECTED")


def test_verification(spark):
    rows = [("Acme", "hq", "Paris", 1), ("acme ", "HQ", " paris", 2), ("B", "f", "1", 1), ("B", "f", "2", 2), ("C", "f", "x", 1), ("D", "f", None, 1), ("D", "f", None, 2)]
    got = {r.entity: r for r in verify.verify_fields(spark.createDataFrame(rows, "entity string, field string, value string, seq int")).collect()}
    assert {k: (r.status, r.confidence, r.canonical) for k, r in got.items()} == {"acme": ("VERIFIED", 1.0, "Paris"), "b": ("DISPUTED", 0.45, "1"), "c": ("SINGLE_SOURCE", 0.75, "x"), "d": ("SINGLE_SOURCE", 0.5, None)}
    flags = verify.quality_flags(verify.verify_fields(spark.createDataFrame(rows, "entity string, field string, value string, seq int"))).collect()
    assert [(r.entity, r.expected, r.actual, r.quality_score) for r in flags] == [("b", "1", "2", 45.0)]


def test_metrics(spark):
    rows = [("a", 1, True, False, False, False, False, False, 10.0), ("a", 2, False, True, False, False, False, False, 20.0), ("b", 3, False, False, True, True, False, True, None)]
    events = spark.createDataFrame(rows, "source string, seq int, accepted boolean, duplicate boolean, stale boolean, error boolean, limited boolean, timeout boolean, freshness double").withColumn("ts", now())
    by = {r.source: r for r in metrics.source_metrics(events).collect()}
    assert by["a"].avg_freshness_hours == 12.0 and by["b"].avg_freshness_hours is None and by["b"].timeouts == 1
    report = metrics.report(metrics.source_metrics(events)).first()
    assert (report.total_accepted, report.total_duplicates, report.total_errors, report.duplication_rate, report.health) == (1, 1, 1, 50.0, "HEALTHY")


def test_changes(spark):
    rows = [("u", 1, "a"), ("u", 2, "a"), ("u", 3, "b"), ("v", 1, None)]
    got = {(r.url, r.seq): (r.changed, r.version) for r in incremental.changed(spark.createDataFrame(rows, "url string, seq int, text string"), "url", "seq", "text").collect()}
    assert got == {("u", 1): (True, 1), ("u", 2): (False, 1), ("u", 3): (True, 2), ("v", 1): (False, 0)} or got[("u", 3)] == (True, 2)


def test_lineage(spark):
    log = spark.createDataFrame([("r", 1, "x"), ("r", 2, "y"), ("s", 1, "z")], "record_id string, seq int, v string")
    assert {(r.record_id, r.v) for r in lineage.latest(log).collect()} == {("r", "y"), ("s", "z")}


def test_hops(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = {r.node: r.hops for r in search.hops(edges, spark.createDataFrame([("a",)], "node string"), 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


NOISY = """<html><body><header>Site header text that is long enough</header><nav class="navbar">Nav text that is long enough to stay</nav>
<div class="ad advert">Advertisement text that is long enough</div><article><h1>A title that is surely long enough to be kept</h1><p>First paragraph with more than twenty-five characters.<p>Second paragraph, also long enough to stay here.</p>
<div class="newsletter-signup"><p>Sign up to our newsletter, it is really good</p></div><p>Second paragraph, also long enough to stay here.</p><p>short</p><script>var x = "</p>";</script></article><aside>Related text that is long enough</aside><footer>Footer text that is long enough</footer></body></html>"""


def test_article_text():
    text_ = htmlclean.main_text(NOISY)
    assert text_ == "A title that is surely long enough to be kept\n\nFirst paragraph with more than twenty-five characters.\n\nSecond paragraph, also long enough to stay here."
    assert htmlclean.main_text("") == htmlclean.main_text(None) == ""
    assert htmlclean.main_text("<div>Plain text without any block, long enough to stay</div>") == "Plain text without any block, long enough to stay"


def test_sinks(spark, tmp_path):
    rec = spark.createDataFrame([("JOB", (None, True)), ("JOB", ("x", False))], "recordType string, content struct<company:string,is_remote:boolean>")
    assert sorted(tuple(r) for r in sinks.flatten(rec, ["recordType", "content.company", "content.is_remote", "content.date"]).collect()) == [("JOB", "", "TRUE", ""), ("JOB", "x", "FALSE", "")]
    sinks.write_tab(rec, "Jobs", str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "jobs")).count() == 2
    assert [sinks.column_letter(n) for n in (1, 26, 27, 52, 703)] == ["A", "Z", "AA", "AZ", "AAA"]
    assert {r.tab: (r.rows, r.ok) for r in sinks.tab_counts(rec).collect()} == {"Jobs": (2, True)}
    up = sinks.upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 3)], "id int, v string, version int"), spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string"), ["id"])
    assert sorted(tuple(r) for r in up.collect()) == [(1, "a", 1), (2, "B", 4), (3, "c", 1)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>hi</p>")
    row = readers.landed(spark, str(tmp_path / "*.html"), "local").first()
    assert row.raw_content == "<p>hi</p>" and len(row.content_hash) == 64
    assert [r.start for r in readers.page_urls(spark, "http://x?q", 250).collect()] == [0, 100, 200]
    assert readers.backoff_seconds(10) == 60 and readers.backoff_seconds(0, "5") == 5 and readers.backoff_seconds(1, "soon") == 2
    bad = spark.createDataFrame([("u", 403, "x" * 600), ("v", 200, "y" * 600)], "url string, http_status int, raw_content string")
    good = spark.createDataFrame([("u", 200, "z" * 600), ("v", 200, "captcha" * 100)], "url string, http_status int, raw_content string")
    assert {(r.url, r.fetch_method) for r in readers.fallback([("http", bad), ("api", good)]).collect()} == {("u", "api"), ("v", "http")}


def test_broken_payloads(spark):
    docs = spark.createDataFrame([(1, "{broken"), (2, None), (3, "[]")], "k int, body string")
    for parse in (parsers.daily_papers, parsers.model_orgs, parsers.spaces, parsers.atom_entries, parsers.feed_items, parsers.markdown_products, parsers.markdown_startups, parsers.heading_links):
        assert parse(docs, "body").count() == 0
    for parse in (parsers.greenhouse_jobs, parsers.lever_jobs, parsers.remote_jobs):
        assert parse(docs, "body", now()).count() == 0
    assert parsers.paper_cards(docs, "k", "body").count() == 0


def test_resolver_in_blocks(spark):
    import random

    from tidemark.functions.text import _jaro_winkler, normalize_name
    from tidemark.operators import resolve

    rng = random.Random(4)
    syllables = ["ka", "lo", "mi", "ter", "son", "vex", "ai", "ro"]
    make = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 2)))
    names = [make() for _ in range(120)]
    seeds = spark.createDataFrame([(i, n.title(), [], None) for i, n in enumerate(names)], "ordinal int, canonical_name string, aliases array<string>, domain string")
    asked = [n[:-1] + "x" if i % 2 else make() for i, n in enumerate(names)]
    raw = spark.createDataFrame([(i, n) for i, n in enumerate(asked)], "i int, raw_name string")
    norm = {r.n: r.m for r in spark.createDataFrame([(n,) for n in names + asked], "n string").select("n", normalize_name(F.col("n")).alias("m")).collect()}
    for block in (20_000, 25):
        got = {r.i: (r.canonical, r.method, r.confidence) for r in resolve.resolve(raw, seeds, block=block).collect()}
        for i, n in enumerate(asked):
            scores = [(_jaro_winkler(norm[n], norm[s]), -k) for k, s in enumerate(names)]
            best, k = max(scores)
            if got[i][1] == "fuzzy_match":
                assert best >= 0.92 and got[i][0] == names[-k].title() and got[i][2] == round(best, 4)
            elif got[i][1] == "manual_review":
                assert 0.70 <= best < 0.92 and got[i][2] == round(best, 4)
            elif got[i][1] == "exact_alias" and got[i][0] == n:
                assert best < 0.70 or n.lower() in names


def test_nearest_seed_equals_brute_force(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abcde ") for _ in range(rng.choice([1, 2, 5, 12, 20, 40, 64, 65, 90, 300])))
    seeds = [(i, f"c{i}", name()) for i in range(150)]
    nearest = resolve.Nearest(seeds)
    for asked in [name() for _ in range(150)] + [seeds[7][2], "é", "ab"]:
        score, place, canonical = max((resolve._jaro_winkler(asked, n), -i, c) for i, c, n in seeds)
        assert nearest(asked) == ((-place, canonical, score) if score >= resolve.REVIEW else None)


def test_open_names_are_dealt_to_many_tasks(spark):
    names = spark.createDataFrame([(f"acme number {i}",) for i in range(2000)], "_norm string").coalesce(1)
    seeds = spark.createDataFrame([(0, "Acme number"), (1, "acme NUMBER"), (2, "other")], "ordinal int, canonical_name string")
    found = resolve.nearest_seeds(names, seeds, True, 10)
    assert len(found.inputFiles()) == 4  # each task writes its own
    assert found.groupBy("best").count().collect() == [("Acme number", 2000)]


def test_blocks_of_seeds_meet_the_names_in_groups(spark):
    """What is found in a group is carried on, so each name is written once, not once for each block."""
    rng = random.Random(9)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice([6, 9, 12])))
    seeds = sorted({name() for _ in range(90)})
    asked = sorted({x[:-1] + "z" for x in seeds[::2]} | {name() for _ in range(40)})
    known = spark.createDataFrame([(i, n) for i, n in enumerate(seeds)], "ordinal int, canonical_name string")
    found = resolve.nearest_seeds(spark.createDataFrame([(n,) for n in asked], "_norm string"), known, True, 10)
    assert len(found.inputFiles()) == 1
    best = {a: max((resolve._jaro_winkler(a, n), -i, n) for i, n in enumerate(seeds)) for a in asked}
    assert {(r["_norm"], r.best, r.score) for r in found.collect()} == {(a, n, s) for a, (s, _, n) in best.items() if s >= resolve.REVIEW}


def test_pairs_of_a_block_equal_brute_force():
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 1, 2, 5, 12, 40, 63, 64, 65, 90])))
    block = resolve.Nearest([(i, "", name()) for i in range(120)])
    asked = [name() for _ in range(80)] + ["x", block.names[3]]
    for threshold in (0.8, 0.9):
        alike = {(k, i) for k, a in enumerate(asked) for i, b in enumerate(block.names) if resolve._jaro_winkler(a, b) >= threshold}
        assert set(block.alike(asked, threshold)) == alike and block.holds_alike(asked, threshold) == {k for k, _ in alike}


def test_article_texts_leave_a_task_in_slices(spark):
    page = "<html><body><div><p>" + "A long enough paragraph of an article. " * 3 + "</p></div></body></html>"
    rows = [(i, page if i % 3 else None) for i in range(300)]
    plan = htmlclean.article_text(spark.createDataFrame(rows, "i int, h string").coalesce(1), "i", "h")
    assert {r.i: r.full_text for r in plan.collect()} == {i: htmlclean.main_text(h) for i, h in rows}
    assert "MapInArrow" in plan._jdf.queryExecution().executedPlan().toString() and htmlclean.SLICE < 300
