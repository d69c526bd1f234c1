import json

from pyspark.sql import functions as F

from tidemark.operators import verify
from tidemark.sources import delivery, readers


def files(path):
    return [json.loads(p.read_text()) for p in sorted(path.glob("part-*"))]


def test_arrays_round_trip(spark, tmp_path):
    rows = [(i, f'"quoted\n{i}"' if i % 3 else None, [i] if i % 2 else None) for i in range(25)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id long, name string, list array<long>, _secret int")
    delivery.write_array(df, str(tmp_path / "a"), per_file=10)
    found = files(tmp_path / "a")
    assert len(found) == 3 and sum(map(len, found)) == 25 and all(set(x) == {"id", "name", "list"} for f in found for x in f)
    assert sorted(tuple(r) for r in readers.records(spark, str(tmp_path / "a")).select("id", "name", "list").collect()) == rows
    delivery.write_array(df.limit(0), str(tmp_path / "none"))
    assert files(tmp_path / "none") == [[]]
    delivery.write_array(df.where("id = 4"), str(tmp_path / "one"))
    assert [x["id"] for x in files(tmp_path / "one")[0]] == [4]


def test_deliver_writes_four_results(spark, tmp_path):
    rows = spark.range(120).select("id")
    delivery.deliver(str(tmp_path), rows, rows, rows.limit(1), rows.limit(3), "id")
    sizes = {p.name: sum(map(len, files(p))) for p in tmp_path.iterdir()}
    assert sizes == {"pipeline_results": 120, "lineage_chains": 50, "observability_report": 1, "entity_mapping_logs": 3}
    assert {x["id"] for f in files(tmp_path / "lineage_chains") for x in f} == set(range(50))


def test_state_round_trip(spark, tmp_path):
    state = [("https://x.com/é\"1", "h1", "2024-01-01T00:00:00", "e", None), ("b\\", "h2", "2024-01-02", None, "m"), ("c", "h3", None, None, None), (None, "h", "t", None, None)]
    df = spark.createDataFrame(state, delivery.STATE)
    delivery.save_state(df, str(tmp_path / "s"))
    whole = {k: v for f in files(tmp_path / "s") for k, v in f.items()}
    assert set(whole) == {state[0][0], "b\\", "c"} and whole["b\\"] == {"url": "b\\", "last_seen_hash": "h2", "last_crawled_at": "2024-01-02", "etag": None, "last_modified": "m"}
    got = sorted(tuple(r) for r in delivery.load_state(spark, str(tmp_path / "s")).collect())
    assert got == sorted(state[:2])  # an entry without its time is left out
    (tmp_path / "s" / "part-broken").write_text("{broken")
    assert delivery.load_state(spark, str(tmp_path / "s")).count() == 2
    assert delivery.load_state(spark, str(tmp_path / "none")).count() == 0
    delivery.save_state(df.limit(0), str(tmp_path / "empty"))
    assert files(tmp_path / "empty") == [{}] and delivery.load_state(spark, str(tmp_path / "empty")).count() == 0


def test_entries(spark):
    texts = ['{"url": "u", "last_seen_hash": "h", "last_crawled_at": "t", "other": 1}', '{"url": "u"}', "no json", None]
    got = [r.e for r in spark.createDataFrame([(t,) for t in texts], "t string").select(delivery.from_entry(F.col("t")).alias("e")).collect()]
    assert got[0].asDict() == {"url": "u", "last_seen_hash": "h", "last_crawled_at": "t", "etag": None, "last_modified": None} and got[1:] == [None] * 3


def test_verification_keeps_the_first_two_values(spark):
    rows = [("A", "f", v, i) for i, v in enumerate(["x", "X ", "y", "z", None])] + [("b", "f", None, 9), (None, "f", "q", 10), (None, "f", "r", 11)]
    got = {r.entity: r for r in verify.verify_fields(spark.createDataFrame(rows, "entity string, field string, value string, seq long")).collect()}
    assert [(g.value, g.n) for g in got["a"].groups] == [("x", 2), ("y", 1)] and got["a"].status == "DISPUTED" and got["a"].distinct_values == 3
    assert got["b"].groups == [] and [g.value for g in got[None].groups] == ["q", "r"]
