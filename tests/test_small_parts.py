from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import ingest


def test_fixed_sources_meet_their_payloads(spark):
    sources = ingest.literal_sources(spark, [("board", "https://a.com/api", "JOB"), ("list", "https://b.com/x", "STARTUP")])
    payloads = spark.createDataFrame([("https://a.com/api", "one"), ("https://c.com", "two")], "source_url string, body string")
    got = ingest.with_config(payloads, sources, api="source_url").collect()
    assert [(r.source_name, r.kind, r.body) for r in got] == [("board", "JOB", "one")]


def test_name_that_a_record_is_compared_by(spark):
    rows = [("STARTUP", "E", None, None, None, None, "u"), ("PRODUCT", None, "S", None, None, None, "u"), ("NEWS", None, None, "T", None, None, "u"), ("RESEARCH_PAPER", "E", None, "P", None, None, "u"), ("JOB", None, None, None, "C", "J", "u"), ("JOB", None, None, None, "C", "", "u"), ("OTHER", "E", "S", "T", "C", "J", "u")]
    columns = ["kind", "entity", "startup", "title", "company", "job_title", "url"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    assert [r.n for r in df.select(text.record_name(*map(F.col, columns)).alias("n")).collect()] == ["E", "S", "T", "P", "C:J", "u", None]
