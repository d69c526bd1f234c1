import math
import random

import duckdb

from tidemark.llm import topk


def brute(rows, k, mod):
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (q, x) in enumerate(good):
        if q % mod == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for j, (i, y) in enumerate(good) if j != at and len(y) == len(x))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(40)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(12)]  # ties
    rows += [(2000, None), (2050, [float("nan")] * 40), (2100, [float("inf")] * 40), (2150, []), (2200, [0.5, None])]
    rows += [(2250, [1.0, 2.0]), (2251, [0.25, -3.0]), (2300, [3000.0 * 2**20 / 256] * 40), (2350, [0.0] * 40)]
    rows += [(3000 + 7 * i, [-1.0 * i, 0.5]) for i in range(5)] + [(2400, []), (2401, []), (None, [0.1] * 40)]
    rows += [(50, rows[50][1]), (50, [0.9] * 40), (50, [0.9] * 40), (1003, rows[0][1])]  # ids that repeat, as queries and candidates
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score string, row int, v int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, 5, 50).collect())
    assert got == brute(rows, 5, 50)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, 5, 50, block=3).collect())
    assert got == brute(rows, 5, 50)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.where("vec_id > 5")).count() == 0


def test_oracle(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    got = sorted(tuple(r) for r in topk.top_k(spark.read.parquet(path)).select("query_id", "rank", "vec_id", "score").collect())
    con = duckdb.connect()
    con.sql(f"create view embeddings as from '{path}'")
    assert got == sorted(con.sql(topk.ORACLE).fetchall())
