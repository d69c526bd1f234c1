import random
import string
import time

from tidemark.functions.text import _jaro_winkler
from tidemark.streaming import jobs

SCHEMA = "block string, seq long, name string"


def brute(rows, threshold=0.9):
    kept, out = {}, {}
    for block, seq, name in sorted(rows, key=lambda r: r[1]):
        twin = name is not None and any(_jaro_winkler(name, k) >= threshold for k in kept.get(block, []))
        out[seq] = "duplicate" if twin else "keep"
        if name is not None and not twin:
            kept.setdefault(block, []).append(name)
    return out


def feed(spark, tmp_path, rows, **options):
    """Rows become one file, and the stream goes on from its checkpoint."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.stream_table(spark, str(tmp_path / "in"), SCHEMA)
    jobs.run_once(jobs.fuzzy_first_seen(stream, "block", "name", "seq", **options), str(tmp_path / "out"), str(tmp_path / "state"))
    return {r.seq: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def names(n, seed):
    rng = random.Random(seed)
    base = ["ac" + "".join(rng.choice(string.ascii_lowercase[:8]) for _ in range(rng.randint(2, 12))) for _ in range(n // 2)]
    return base + [x[:-1] + rng.choice("abc") for x in base]


def test_a_hot_block_over_restarts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs.FirstOfSimilar.__init__, "__defaults__", (7,))  # many pages
    pool = names(240, 1)
    random.Random(2).shuffle(pool)
    rows = [("hot" if i % 4 else f"b{i % 3}", i, n) for i, n in enumerate(pool)] + [("hot", 900, None), ("hot", 901, None), ("hot", 902, ""), ("hot", 903, "")]
    for at in range(0, len(rows), 100):
        got = feed(spark, tmp_path, rows[at : at + 100])
    assert got == brute(rows)
    assert got[900] == got[901] == "keep" and got[903] == "duplicate"


def test_pages_are_forgotten_after_their_time(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        _forgotten(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def _forgotten(spark, tmp_path):
    assert feed(spark, tmp_path, [("b", 1, "acme works")], ttl="2 seconds") == {1: "keep"}
    time.sleep(3)
    assert feed(spark, tmp_path, [("b", 2, "acme works"), ("b", 3, "acme work")], ttl="2 seconds") == {1: "keep", 2: "keep", 3: "duplicate"}
