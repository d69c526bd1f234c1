"""Record schemas: cases of every record type."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validate

SOURCE = {"name": "List", "url": "https://example.com/a"}
GOOD = {
    "STARTUP": {"schemaVersion": "1.0", "recordType": "STARTUP", "source": SOURCE, "content": {"entityName": "Acme", "data": {"employeeCount": 5}}, "collectedAt": "2024-01-01T00:00:00Z"},
    "PRODUCT": {"recordType": "PRODUCT", "source": SOURCE, "content": {"startupName": None, "pricingModel": "FREE"}, "collectedAt": "2024-01-01T00:00:00+00:00"},
    "RESEARCH_PAPER": {"content": {"title": "T", "authors": ["A", "B"], "paper_url": "https://arxiv.org/abs/2401.00001", "github_stars": 0, "published_date": "2024-01-01"}},
    "JOB": {"source": SOURCE, "content": {"company": "C", "date": "2024-01-01T10:00:00Z", "is_remote": True, "role_family": "Engineering"}, "collectedAt": "2024-01-01T00:00:00Z"},
    "NEWS": {"source": SOURCE, "content": {"title": "T", "fullText": "x", "publishedAt": "2024-01-01T10:00:00Z", "mentionedEntities": []}, "collectedAt": "2024-01-01T00:00:00Z"},
    "ENTITY_MAPPING": {"rawName": "a", "canonicalName": None, "method": "exact_alias", "confidence": 1, "sourceUrl": "http://x.com", "decision": "ACCEPTED"},
    "QUALITY_FLAG": {"record_type": "JOB", "record_id": "r", "flag_type": "stale_data", "field_name": "date", "quality_score": 99.5},
}


def broken(kind, path, value=None, drop=False):
    record = json.loads(json.dumps(GOOD[kind]))
    at = record
    *parents, last = path.split(".")
    for p in parents:
        at = at[p]
    if drop:
        del at[last]
    else:
        at[last] = value
    return json.dumps(record)


CASES = [
    ("STARTUP", broken("STARTUP", "source.url", "not-a-url"), "source.url: not a URL"),
    ("STARTUP", broken("STARTUP", "source.url", "ftp://x.com/a"), "source.url: not a URL"),
    ("STARTUP", broken("STARTUP", "source.name", ""), "source.name: too short"),
    ("STARTUP", broken("STARTUP", "content.entityName", ""), "content.entityName: too short"),
    ("STARTUP", broken("STARTUP", "content.entityName", None), "content.entityName: missing"),
    ("STARTUP", broken("STARTUP", "content.entityName", 5), "content.entityName: not of kind text"),
    ("STARTUP", broken("STARTUP", "content.data.employeeCount", -1), "content.data.employeeCount: too small"),
    ("STARTUP", broken("STARTUP", "content.data.employeeCount", 1.5), "content.data.employeeCount: not of kind whole"),
    ("STARTUP", broken("STARTUP", "content.data.employeeCount", "many"), "content.data.employeeCount: not of kind whole"),
    ("STARTUP", broken("STARTUP", "content.data.foo", 1), "content.data.foo: not in the schema"),
    ("STARTUP", broken("STARTUP", "extra", 1), "extra: not in the schema"),
    ("STARTUP", broken("STARTUP", "recordType", "JOB"), "recordType: not among the choices"),
    ("STARTUP", broken("STARTUP", "schemaVersion", "one"), "schemaVersion: wrong form"),
    ("STARTUP", broken("STARTUP", "collectedAt", "soon"), "collectedAt: not a time"),
    ("STARTUP", broken("STARTUP", "collectedAt", drop=True), "collectedAt: missing"),
    ("PRODUCT", broken("PRODUCT", "content.pricingModel", "CHEAP"), "content.pricingModel: not among the choices"),
    ("RESEARCH_PAPER", broken("RESEARCH_PAPER", "content.github_stars", -3), "content.github_stars: too small"),
    ("RESEARCH_PAPER", broken("RESEARCH_PAPER", "content.authors", ["a", 3]), "content.authors: not of kind texts"),
    ("RESEARCH_PAPER", broken("RESEARCH_PAPER", "source", SOURCE), "source: not in the schema"),
    ("JOB", broken("JOB", "content.role_family", "Cook"), "content.role_family: not among the choices"),
    ("JOB", broken("JOB", "content.is_remote", "yes"), "content.is_remote: not of kind flag"),
    ("NEWS", broken("NEWS", "content.fullText", ""), "content.fullText: too short"),
    ("ENTITY_MAPPING", broken("ENTITY_MAPPING", "confidence", 1.5), "confidence: too large"),
    ("ENTITY_MAPPING", broken("ENTITY_MAPPING", "confidence", -0.1), "confidence: too small"),
    ("QUALITY_FLAG", broken("QUALITY_FLAG", "status", "DONE"), "status: not among the choices"),
    ("JOB", "[1]", "not an object"),
    ("JOB", "{broken", "not an object"),
    ("JOB", None, "not an object"),
]


def test_each_rule(spark):
    rows = [(i, kind, text) for i, (kind, text, _) in enumerate(CASES)] + [(100 + i, kind, json.dumps(x)) for i, (kind, x) in enumerate(GOOD.items())] + [(200, "BOAT", "{}")]
    df = spark.createDataFrame(rows, "i int, recordType string, json string")
    got = {r.i: (r.violations, r.status) for r in validate.validate_by_type(df).collect()}
    for i, (_, _, message) in enumerate(CASES):
        assert got[i] == ([message], "FAILED"), CASES[i]
    assert all(got[100 + i] == ([], "PASSED") for i in range(len(GOOD)))
    assert got[200] == (["recordType: no such schema"], "FAILED")


@pytest.mark.parametrize("kind", ["STARTUP", "JOB"])
def test_round_trip_and_order(spark, kind):
    df = spark.createDataFrame([(json.dumps(GOOD[kind]),), ('{"source":{"name":"","url":"x","z":1},"a":2}',)], "json string")
    good, bad = validate.validate(df, kind).orderBy(F.desc("status")).collect()
    assert good.status == "PASSED" and json.loads(good.json) == GOOD[kind]
    assert bad.violations[:3] == ["source.name: too short", "source.url: not a URL", "content: missing"] and bad.violations[-2:] == ["a: not in the schema", "source.z: not in the schema"]


def test_drift_alerts(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b", "STARTUP", broken("STARTUP", "content.entityName", "" if i % 2 else "ok")) for i in range(8)], "seq int, source string, recordType string, json string")
    got = {r.source: (r.broken, [tuple(a) for a in r.alerts]) for r in validate.drift_alerts(validate.validate_by_type(df)).collect()}
    assert got == {"a": (3, [("content.entityName: too short", 3, 1)]), "b": (1, [("content.entityName: too short", 1, 7)])}


def test_records_are_read_once_by_many_tasks(spark):
    from tidemark.plans import ingest

    assert ingest._startups(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([(1, "a", json.dumps(GOOD["STARTUP"]))], "seq int, source string, json string")
    plan = validate.drift_alerts(validate.validate(df, "STARTUP"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson(") == 1  # twice with a filter that moves below the rules
