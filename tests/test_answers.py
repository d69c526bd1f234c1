import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import answers, crawl


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join((r if isinstance(r, bytes) else json.dumps(r).encode()) + b"\n" for r in rows))


def read(spark, folder, **options):
    answers.register(spark)
    return spark.read.format("landed_answers").options(path=str(folder), **options).load()


def rows(first, n, source="a"):
    return [{"source": source, "url": f"https://x.com/{k}", "attempt": k % 3, "http_status": 200, "at": float(k), "raw_content": "é" * (k % 50)} for k in range(first, first + n)]


@pytest.mark.parametrize("split", [1, 7, 100, 4096, 1 << 26])
def test_every_line_is_read_once_whatever_the_pieces(spark, tmp_path, split):
    n = 40 if split < 100 else 400
    put(tmp_path, "1.jsonl", rows(0, n))
    (tmp_path / "2.jsonl").write_bytes(b"\n\n" + b"\n".join(json.dumps(r).encode() for r in rows(n, 30)))  # no line end at the end
    put(tmp_path, "_ignored", rows(900, 3))
    if split == 1:  # each byte is a piece
        sizes = answers.files(str(tmp_path))
        got = [line for name, size in sizes for at in range(size) for line in answers.lines(str(tmp_path), name, at, at + 1) if line.strip()]
        assert [json.loads(x)["at"] for x in got] == list(range(n + 30))
        return
    got = read(spark, tmp_path, splitBytes=split)
    assert sorted(r.at for r in got.collect()) == list(range(n + 30))
    assert got.rdd.getNumPartitions() >= sum(p.stat().st_size for p in tmp_path.glob("*.jsonl")) // split


def test_rules_and_broken_lines(spark, tmp_path):
    base = {"source": "s", "url": "u", "attempt": 2}
    put(tmp_path, "a", [{**base, "http_status": 503}, {**base, "http_status": 429, "retry_after": " 90 "}, base, {**base, "http_status": 404, "headers": {"X-RateLimit-Remaining": "3"}}, {**base, "http_status": 200, "headers": {"x-ratelimit-remaining": 60}}, b"<html>", b"[1]", {"source": 5, "attempt": "x", "http_status": True, "raw_content": {"a": 1}, "at": 1 << 40}])
    got = [(r.http_status, r.retried, r.wait, r.quota_left, r.quota_low) for r in read(spark, tmp_path).collect()]
    assert got == [(503, True, 4.0, None, False), (429, True, 90.0, None, False), (None, True, 4.0, None, False), (404, False, None, 3, True), (200, False, None, 60, False), (None, None, None, None, None), (None, None, None, None, None), (None, True, 1.0, None, False)]
    last = read(spark, tmp_path).collect()[-3:]
    assert [r.raw_content for r in last] == ["<html>", "[1]", '{"a": 1}'] and last[2].source == "5"
    assert read(spark, tmp_path, retries=1).count() == 3 and read(spark, tmp_path, low=2).where("quota_low").count() == 0


def test_sources_option(spark, tmp_path):
    put(tmp_path, "a", rows(0, 10) + rows(10, 5, "b") + rows(15, 5, "c"))
    assert read(spark, tmp_path, sources="a, c").where("source <> 'a'").count() == 5
    assert read(spark, tmp_path).where("source IN ('b', 'c') AND at > 12").count() == 7


def test_stream_resumes_from_its_offset(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    answers.register(spark)

    def run():
        stream = spark.readStream.format("landed_answers").option("path", str(folder)).option("splitBytes", 700).load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["numInputRows"] if query.lastProgress else 0

    put(folder, "001", rows(0, 20))
    put(folder, "002", rows(20, 20))
    assert run() == 40
    put(folder, "003", rows(40, 7))
    assert run() == 7
    run()
    assert sorted(r.at for r in spark.read.parquet(out).collect()) == list(range(47))
    settled = crawl.settled(spark.read.parquet(out).select("url", "attempt", "http_status", "retry_after", "raw_content"))
    assert settled.where("outcome = 'ok'").count() == 47


def test_missing_folder_is_empty(spark, tmp_path):
    assert read(spark, tmp_path / "none").count() == 0
    assert read(spark, tmp_path / "none").agg(F.max("at")).first()[0] is None
