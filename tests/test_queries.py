"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

import duckdb
import pytest

from tidemark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{FOLDER}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(norm(x) for x in v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in catalog.oracle_sql():
        assert got
        return
    rel = duck.sql(catalog.oracle_sql()[name])
    names = rel.columns
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
