from pyspark.sql import functions as F

from tests.test_operators import brute_survivors
from tidemark.functions import text
from tidemark.operators import resolve, runner
from tidemark.sources import parsers
from tidemark.tables import stored


def routes():
    named = lambda kind: {"record_type": F.lit(kind), "name": F.col("name"), "url": F.col("link")}
    return [("/startups", lambda p: parsers.markdown_startups(p, "body"), named("STARTUP")), ("/products", lambda p: parsers.markdown_products(p, "body"), named("PRODUCT"))]


PAYLOADS = [
    (1, "https://l.com/startups/1", "## A\n- [Acme Labs](https://acme.com) - x\n- [Open AI](https://one.com) - x\n- [Acme Labz](https://other.com) - x"),
    (2, "https://l.com/startups/2", "## A\n- [Openai](https://two.com) - x\n- [Zeta](https://acme.com/about) - x\n- [Brandnew](https://new.com) - x"),
    (3, "https://l.com/products/3", "## B\n- [Gadget One](https://g.com/1) - x\n- [Gadget Onee](https://g.com/2) - x\n- [Widget](https://g.com/1) - x"),
    (4, "https://elsewhere.com/", "## B\n- [Nobody](https://n.com) - x"),
]
SEEDS = [(0, "OpenAI", ["Open AI"], "openai.com")]


def inputs(spark, rows=PAYLOADS):
    seeds = spark.createDataFrame(SEEDS, "ordinal int, canonical_name string, aliases array<string>, domain string")
    return spark.createDataFrame(rows, "id int, source_url string, body string"), seeds


def test_run_equals_its_steps_by_hand(spark):
    payloads, seeds = inputs(spark)
    run = runner.run(payloads, routes(), seeds, keys=("id",))
    rows = run.records.orderBy("seq").collect()
    # the steps one by one, on the driver
    names = [(r.id, r.record_type, r.name, r.url) for r in rows]
    assert names == sorted(names, key=lambda x: x[0])
    steps = spark.createDataFrame([(k, *n) for k, n in enumerate(names)], "seq long, id int, kind string, name string, url string")
    keyed = steps.select("seq", text.exact_key(F.col("kind"), F.col("url"), F.col("name"), F.lit(None).cast("string"), F.col("url")), text.normalize_key(F.col("name")), text.block_key(F.col("name"), F.col("kind")))
    expected = brute_survivors([tuple(r) for r in keyed.collect()], 0.90)
    assert [r.status for r in rows] == [expected[k] for k in range(len(rows))]
    assert [n[2] for n in names].count("OpenAI") == 2  # both spellings became the resolver's
    assert {r.url for r in run.survivors().collect()} == {r.url for r in rows if r.status == "keep"} and "Nobody" not in {n[2] for n in names}


def test_counters_are_observed(spark):
    payloads, seeds = inputs(spark)
    run = runner.run(payloads, routes(), seeds, keys=("id",))
    rows = stored(run.records).collect()
    counts = run.counters()
    for kind in runner.TYPES:
        mine = [r for r in rows if r.record_type == kind]
        assert counts["crawled"][kind] == len(mine)
        assert counts["accepted"][kind] == sum(r.status == "keep" for r in mine)
        assert counts["duplicates"][kind] == sum(r.status != "keep" for r in mine)
    raw = spark.createDataFrame([(n,) for n in ["Acme Labs", "Open AI", "Acme Labz", "Openai", "Zeta", "Brandnew", "Gadget One", "Gadget Onee", "Widget"]], "raw_name string")
    decisions = {r.decision: r["count"] for r in resolve.resolve(raw, seeds).groupBy("decision").count().collect()}
    assert {d: n for d, n in counts["decisions"].items() if n} == decisions


def test_no_payloads(spark):
    payloads, seeds = inputs(spark)
    run = runner.run(payloads.limit(0), routes(), seeds, keys=("id",))
    assert stored(run.records).collect() == [] and set(run.counters()["crawled"].values()) == {0}
