import random
import re

from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.streaming import jobs

NAMES = "ordinal long, name string"


def brute(text, names):
    low = (text or "").lower()
    return [i for i, n in names if n and re.search(rf"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w)){re.escape(n.lower())}(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))", low)]


def test_mentions_equal_patterns(spark):
    names = list(enumerate(["OpenAI", "xAI", "AI", "Meta AI", "C++", ".NET", "a", "é", "openai", "", None, "Ünited Lab", "a_b"]))
    texts = ["OpenAI's AI", "xai and XAI", "taxai", "Meta AI Meta AIs", "C++ c++x", "x.NET .net", "", None, "É a é", "ünited LAB", "a_b a b", "a" * 100_000, "_ai ai_", "AI"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for block in (100, 3):
        got = {r.i: r.mentioned for r in lookup.mentions(rows, "text", spark.createDataFrame(names, NAMES), block=block).collect()}
        assert got == {i: brute(t, names) for i, t in enumerate(texts)}


def test_ten_thousand_names_in_one_pass(spark):
    rng = random.Random(5)
    names = [(i, f"name{i} corp") for i in range(10_000)]
    held = {i: sorted(rng.sample(range(10_000), 3)) for i in range(300)}
    rows = spark.createDataFrame([(i, " and ".join(f"Name{k} Corp" for k in ks) + " name77corp") for i, ks in held.items()], "i int, text string")
    found = lookup.mentions(rows, "text", spark.createDataFrame(names, NAMES))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.i: r.mentioned for r in found.collect()} == held


def test_no_names_and_no_texts(spark):
    none = spark.createDataFrame([], NAMES)
    rows = spark.createDataFrame([(1, "x")], "i int, text string")
    assert [r.mentioned for r in lookup.mentions(rows, "text", none).collect()] == [[]]
    assert lookup.mentions(rows.limit(0), "text", spark.createDataFrame([(1, "x")], NAMES)).collect() == []


def test_hosts_by_their_parents(spark):
    table = spark.createDataFrame([("google.com", "Google", 1), ("maps.google.com", "Maps", 2), ("X.ai", "xAI", 0), ("com", "Dot", 9)], "host string, company string, ordinal int")
    rows = spark.createDataFrame([("google.com",), ("a.maps.google.com",), ("notgoogle.com",), ("API.x.ai",), ("ai",), (None,), ("",), ("google.com",)], "at string")
    got = sorted((r.at or "", r.company) for r in lookup.by_host(rows, "at", table).collect())
    assert got == [("", None), ("", None), ("API.x.ai", "xAI"), ("a.maps.google.com", "Google"), ("ai", None), ("google.com", "Google"), ("google.com", "Google"), ("notgoogle.com", "Dot")]


RECORDS = "doc long, kind string, title string, body string, pricing string"
SEARCHES = "search_id long, query string, kind string, pricing string, frequency string"


def brute_alerts(records, searches):
    out = []
    for doc, kind, title, body, pricing in records:
        for s, q, k, p, f in searches:
            fits = k in ("ALL", kind) and (p == "ALL" or kind != "PRODUCT" or (pricing or "UNVERIFIED") == p)
            if fits and (not (q or "").strip() or q.lower() in (title or "").lower() or q.lower() in (body or "").lower()):
                out.append((s, f, doc))
    return sorted(out)


def case():
    rng = random.Random(8)
    word = lambda: rng.choice(["alpha", "Beta", "gam ma", "", None, "delta beta"])
    records = [(i, rng.choice(["NEWS", "PRODUCT", "JOB"]), word(), word(), rng.choice(["FREE", "PAID", None])) for i in range(80)]
    searches = [(i, rng.choice(["ALPHA", "a", "beta", " ", "", None, "m m", "alphabeta", "zz"]), rng.choice(["ALL", "NEWS", "PRODUCT"]), rng.choice(["ALL", "FREE", "UNVERIFIED"]), "INSTANT") for i in range(40)]
    return records, searches


def test_saved_searches(spark):
    records, searches = case()
    found = lookup.alerts(spark.createDataFrame(records, RECORDS), spark.createDataFrame(searches, SEARCHES), [F.col("title"), F.col("body")], "kind", F.col("pricing"))
    assert sorted((r.search_id, r.frequency, r.doc) for r in found.collect()) == brute_alerts(records, searches)
    assert found.columns == ["search_id", "frequency", "doc", "kind", "title", "body", "pricing"]


def test_saved_searches_over_a_stream(spark, tmp_path):
    records, searches = case()
    spark.createDataFrame(records, RECORDS).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = jobs.stream_table(spark, str(tmp_path / "in"), RECORDS, files_per_trigger=1)
    found = lookup.alerts(stream, spark.createDataFrame(searches, SEARCHES), [F.col("title"), F.col("body")], "kind", F.col("pricing"))
    jobs.run_once(found, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r.search_id, r.frequency, r.doc) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == brute_alerts(records, searches)


def test_counts_of_saved_searches(spark):
    records, searches = case()
    searches += [(100, "beta", "NEWS", None, "DAILY"), (101, " ", "PRODUCT", "FREE", None)]
    want = {}
    for s, _, doc in brute_alerts(records, searches[:40]):
        n, first = want.get(s, (0, doc))
        want[s] = (n + 1, min(first, doc))
    args = [F.col("title"), F.col("body")], "kind", F.col("pricing"), "doc"
    got = {r.search_id: (r.n, r["first"]) for r in lookup.alert_counts(spark.createDataFrame(records, RECORDS), spark.createDataFrame(searches, SEARCHES), *args).collect()}
    assert {s: v for s, v in got.items() if s < 100} == want
    news = [d for d, k, t, b, _ in records if k == "NEWS" and "beta" in f"{t} {b}".lower()]
    free = [d for d, k, _, _, p in records if k == "PRODUCT" and p == "FREE"]
    assert got[100] == (len(news), min(news)) and got[101] == (len(free), min(free))


def test_searches_that_share_a_query_are_one_name(spark):
    searches = spark.createDataFrame([(i, ["a", "B"][i % 2], "ALL", "ALL", "INSTANT") for i in range(500)], SEARCHES)
    seen = []
    plain, lookup.found_in = lookup.found_in, lambda *args, **more: seen.append(args[2].count()) or plain(*args, **more)
    try:
        found = lookup.alerts(spark.createDataFrame([(1, "NEWS", "ab", "", None)], RECORDS), searches, [F.col("title")], "kind", F.col("pricing"))
    finally:
        lookup.found_in = plain
    assert found.count() == 500 and seen == [2]
