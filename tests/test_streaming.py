from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.streaming import jobs

EVENTS = "/root/testdata/sf0.001/events.parquet"


def landed(spark, tmp_path, df, parts=3):
    df.repartition(parts).write.parquet(str(tmp_path / "in"))
    return jobs.stream_table(spark, str(tmp_path / "in"), df.schema, files_per_trigger=1)


def run(spark, tmp_path, stream, name, mode="append"):
    jobs.run_once(stream, str(tmp_path / name), str(tmp_path / f"{name}_state"), mode)
    return spark.read.parquet(str(tmp_path / name))


def test_exact_dedup_like_batch(spark, tmp_path):
    events = spark.read.parquet(EVENTS)
    out = run(spark, tmp_path, jobs.first_seen(landed(spark, tmp_path, events), "user_id"), "dedup")
    assert out.count() == events.select("user_id").distinct().count()


def test_changes_like_batch(spark, tmp_path):
    rows = spark.createDataFrame([("u", i, "ab"[i // 3 % 2]) for i in range(12)] + [("v", i, "x") for i in range(3)], "url string, seq long, body string")
    parts = rows.where("seq < 5"), rows.where("seq >= 5")
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.stream_table(spark, str(tmp_path / "in"), rows.schema)
    got = {(r.url, r.seq): r.changed for r in run(spark, tmp_path, jobs.changes(stream, "url", "seq", "body"), "changes").collect()}
    assert got == {(r.url, r.seq): r.changed for r in incremental.changed(rows, "url", "seq", "body").collect()}


def test_fuzzy_state(spark, tmp_path):
    rows = spark.createDataFrame([("A:ac", 1, "acme"), ("A:ac", 2, "acmee"), ("A:ac", 3, "acorn"), ("B:ac", 4, "acme")], "block string, seq long, name string")
    got = {r.seq: r.status for r in run(spark, tmp_path, jobs.fuzzy_first_seen(landed(spark, tmp_path, rows, 1), "block", "name", "seq"), "fuzzy").collect()}
    assert got == {1: "keep", 2: "duplicate", 3: "keep", 4: "keep"}


def test_telemetry_and_alerts(spark, tmp_path):
    events = spark.read.parquet(EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))
    out = run(spark, tmp_path, jobs.telemetry(landed(spark, tmp_path, events.orderBy("ts"), 1), "ts", "event_type"), "telemetry")
    batch = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
    assert out.exceptAll(batch).count() == 0 and out.count() > 0
    stream = jobs.stream_table(spark, str(tmp_path / "in"), events.schema)
    assert run(spark, tmp_path, jobs.alerts(stream, "event_type = 'error'", "ts", "INSTANT"), "instant").count() == events.where("event_type = 'error'").count()
    assert run(spark, tmp_path, jobs.alerts(stream, "event_type = 'error'", "ts", "WEEKLY"), "weekly").count() >= 1


def test_freshness_against_the_clock(spark, tmp_path):
    events = spark.read.parquet(EVENTS)
    now = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    out = run(spark, tmp_path, jobs.only_fresh(landed(spark, tmp_path, events), "ts", now), "fresh")
    assert out.count() == events.where("ts BETWEEN TIMESTAMP_NTZ '2024-01-14 00:00:00' AND TIMESTAMP_NTZ '2024-01-15 00:00:00'").count()


def test_moving_average_like_batch(spark, tmp_path):
    rows = spark.createDataFrame([("ab"[i % 2], i, float(i * 7 % 13) if i % 5 else None) for i in range(40)], "source string, seq long, freshness double")
    for part in (rows.where("seq < 17"), rows.where("seq >= 17")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = run(spark, tmp_path, jobs.moving_average(jobs.stream_table(spark, str(tmp_path / "in"), rows.schema), "source", "seq", "freshness"), "ewma")
    last = {r.source: (r.a, r.n) for r in out.groupBy("source").agg(F.max_by("average", "n").alias("a"), F.max("n").alias("n")).collect()}
    from tidemark.operators import metrics

    assert {k: a for k, (a, _) in last.items()} == {r.source: r.average for r in metrics.moving_average(rows).collect()}
    assert sum(n for _, n in last.values()) == rows.where("freshness IS NOT NULL").count()


def test_cache_holds_for_its_time(spark, tmp_path):
    rows = spark.createDataFrame([("k", 0, "a"), ("k", 1800, "b"), ("k", 3599, "c"), ("k", 3600, "d"), ("k", 5000, "e"), ("j", 10, "x")], "key string, t long, v string").withColumn("at", F.timestamp_seconds(F.col("t") + 1_000_000))
    for part in (rows.where("t < 1000"), rows.where("t >= 1000 and t < 3600"), rows.where("t >= 3600")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = run(spark, tmp_path, jobs.cached(jobs.stream_table(spark, str(tmp_path / "in"), rows.schema), "key", "v", "at", "1 hour"), "cache")
    got = sorted((r.key, int(r.at.timestamp()) - 1_000_000, r.value, r.hit) for r in out.collect())
    assert got == [("j", 10, "x", False), ("k", 0, "a", False), ("k", 1800, "a", True), ("k", 3599, "a", True), ("k", 3600, "d", False), ("k", 5000, "d", True)]


def test_dead_letters(spark, tmp_path):
    good = '{"rawName":"a","method":"exact_alias","confidence":1,"sourceUrl":"https://x.com","decision":"ACCEPTED"}'
    rows = spark.createDataFrame([(i, good if i % 3 else "{broken") for i in range(12)], "i long, json string")
    stream = landed(spark, tmp_path, rows)
    jobs.with_dead_letters(stream, "ENTITY_MAPPING", "json", str(tmp_path / "ok"), str(tmp_path / "dead"), str(tmp_path / "state"))
    assert {r.i for r in spark.read.parquet(str(tmp_path / "ok")).collect()} == {i for i in range(12) if i % 3}
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert {r.i for r in dead} == {0, 3, 6, 9} and all(r.violations == ["not an object"] for r in dead)


def test_progress_is_logged_as_json(spark, tmp_path, caplog):
    import json
    import logging
    import time

    from tidemark.streaming.progress import JsonProgress

    listener = JsonProgress()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, "tidemark.streaming"):
            run(spark, tmp_path, landed(spark, tmp_path, spark.range(9).toDF("k"), 1), "logged")
            for _ in range(50):
                said = [json.loads(r.message) for r in caplog.records]
                if any(x["event"] == "query_terminated" for x in said):
                    break
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert {"query_started", "query_progress", "query_terminated"} <= {x["event"] for x in said}
    assert sum(x["rows"] for x in said if x["event"] == "query_progress") == 9
