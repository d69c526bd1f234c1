"""Queries that once read a part of their table, on tables larger than that part."""

import duckdb
import pytest

from tidemark.plans import catalog


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    con = duckdb.connect()
    con.sql(f"copy (select * from '/root/testdata/sf0.01/part.parquet' where p_partkey between 300 and 600) to '{path}/part.parquet'")
    con.sql(f"copy (select i as doc_id, 'x' as text from range(2100) t(i)) to '{path}/documents.parquet'")
    return path


@pytest.mark.parametrize("name", ["fuzzy_pairs", "dedup_survivors", "dedup_stats"])
def test_records_beyond_400(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"create view part as from '{folder}/part.parquet'")
    rel = con.sql(catalog.oracle_sql()[name])
    got = catalog.queries()[name](spark, folder).select(*rel.columns).collect()
    rounded = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert sorted(map(rounded, got)) == sorted(map(rounded, rel.fetchall()))
    if name == "dedup_survivors":
        assert {r.seq for r in got} == set(range(300, 601))


def test_web_extract_takes_400(spark, folder):
    counts = {r.kind: r["count"] for r in catalog.queries()["web_extract"](spark, folder).groupBy("kind").count().collect()}
    assert counts == {"STARTUP": 400, "PRODUCT": 400, "RESEARCH_PAPER": 400, "JOB": 420, "NEWS": 420}
