import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import text_index, vector_index

TEXTS = "id long, text string"


def clustered(spark, n=3000, kinds=40, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(kinds, dim))
    rows = [(i, [float(x) for x in middles[i % kinds] + rng.normal(size=dim) * 0.25]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, vec array<double>")


def nearest(rows, q, k):
    unit = lambda v: np.asarray(v) / np.linalg.norm(v)
    return sorted(((-round(float(unit(v) @ unit(q)), 6), i) for i, v in rows))[:k]


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    rows, df = clustered(spark)
    path = str(tmp_path_factory.mktemp("vectors"))
    vector_index.build(df, path, "id", "vec")
    return rows, df, path


def test_exact_search_equals_a_full_scan(spark, vectors):
    rows, _, path = vectors
    rng = np.random.default_rng(4)
    for q in [rows[5][1], [float(x) for x in rng.normal(size=16)], [-x for x in rows[9][1]]]:
        got = [(-r.score, r.id) for r in vector_index.search(spark, path, q, 10).collect()]
        assert got == nearest(rows, q, 10)


def test_search_reads_only_its_lists(spark, vectors):
    rows, _, path = vectors
    everything = spark.read.parquet(f"{path}/vectors").inputFiles()
    few = vector_index.members(spark, path, [0, 1])
    files = {r.f for r in few.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("list=0/" in f or "list=1/" in f for f in files) and len(files) < len(everything) / 4
    assert re.search(r"PartitionFilters: \[[^\]]*list", few._jdf.queryExecution().executedPlan().toString())
    k = 10
    exact = {i for _, i in nearest(rows, rows[7][1], k)}
    got = {r.id for r in vector_index.search(spark, path, rows[7][1], k, probes=3).collect()}
    assert len(got & exact) >= 9


def test_recall_of_many_queries(spark, vectors):
    rows, df, path = vectors
    asked = df.where("id % 37 = 0").withColumnRenamed("id", "q")
    got = vector_index.search_many(asked, path, "q", "vec", 10).collect()
    lists = len(vector_index.lists_of(spark, path))
    probes = spark.read.parquet(f"{path}/settings").first().probes
    assert probes < lists / 3 and max(r.place for r in got) < probes
    found = Counter()
    for i, v in rows:
        if i % 37 == 0:
            exact = {j for _, j in nearest(rows, v, 10)}
            found["all"] += len(exact)
            found["hit"] += len(exact & {r.id for r in got if r.query == i})
    assert found["hit"] >= 0.95 * found["all"]
    assert all(r["rank"] <= 10 for r in got)


def test_vectors_without_direction(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [0.0, 2.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    vector_index.build(df, str(tmp_path), "id", "vec")
    assert [(r.id, r.score) for r in vector_index.search(spark, str(tmp_path), [0.0, 1.0], 5).collect()] == [(7, 1.0), (7, 1.0), (1, 0.0)]
    vector_index.build(df.limit(0), str(tmp_path / "none"), "id", "vec")
    assert vector_index.search(spark, str(tmp_path / "none"), [0.0, 1.0], 5).collect() == []
    assert vector_index.search_many(df, str(tmp_path / "none"), "id", "vec").collect() == []


def brute_bm25(docs, terms, k):
    words = {i: [w for w in re.split(r"[\W_]+", t.lower()) if w] for i, t in docs if t is not None}
    n, average = len(docs), sum(map(len, words.values())) / len(words)
    df = Counter(t for w in words.values() for t in set(w) if t in terms)
    out = []
    for i, w in words.items():
        tf = Counter(x for x in w if x in terms)
        if tf:
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / average)) for t, f in tf.items())
            out.append((-round(s, 6), i))
    return sorted(out)[:k]


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    return [(i, None if i % 97 == 5 else " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60))) + rng.choice(["", "!", " W1"])) for i in range(n)]


@pytest.mark.parametrize("terms, k", [(["w1", "w40"], 10), (["w0"], 5), (["w59", "w58", "nothing"], 50), (["nothing"], 3), ([], 3), (["w3", "w3", "w7"], 10_000)])
def test_text_index_equals_brute_force(spark, tmp_path, terms, k):
    docs = corpus(700, 3)
    text_index.build(spark.createDataFrame(docs, TEXTS), str(tmp_path), "id", "text", segment=50)
    got = [(-r.score, r.id) for r in text_index.search(spark, str(tmp_path), terms, k).collect()]
    assert got == brute_bm25(docs, terms, k)


def test_batches_add_up_and_replace_themselves(spark, tmp_path):
    docs = corpus(400, 8)
    first, second = docs[:250], docs[250:]
    text_index.build(spark.createDataFrame(first, TEXTS), str(tmp_path), "id", "text", batch=0, segment=40)
    for _ in range(2):
        text_index.build(spark.createDataFrame(second, TEXTS), str(tmp_path), "id", "text", batch=1, segment=40)
    got = [(-r.score, r.id) for r in text_index.search(spark, str(tmp_path), ["w2", "w30"], 20).collect()]
    assert got == brute_bm25(docs, ["w2", "w30"], 20)


def test_a_query_reads_its_terms_only(spark, tmp_path):
    docs = corpus(500, 2)
    text_index.build(spark.createDataFrame(docs, TEXTS), str(tmp_path), "id", "text", segment=50)
    rows = text_index.postings(spark, str(tmp_path), ["w4"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan) and re.search(r"PushedFilters: \[[^\]]*EqualTo\(term,w4\)", plan)
    assert {r.term for r in rows.collect()} == {"w4"}
    whole = spark.read.parquet(str(tmp_path / "postings"))
    assert len({r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()}) < len(whole.inputFiles()) / 10


def test_empty_documents(spark, tmp_path):
    text_index.build(spark.createDataFrame([], TEXTS), str(tmp_path), "id", "text")
    assert text_index.search(spark, str(tmp_path), ["w1"], 3).collect() == []


def shuffled(spark):
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = store.stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_texts_are_shuffled_once_and_words_never(spark, tmp_path):
    docs = corpus(600, 4)
    df = spark.createDataFrame(docs, TEXTS)
    before = shuffled(spark)
    text_index.build(df, str(tmp_path), "id", "text", segment=50)
    assert shuffled(spark) - before < 2 * len(docs)  # each of them has some 20 different words


def test_postings_of_repeated_and_missing_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "TASK_WORDS", 100)
    rng = random.Random(6)
    docs = [(rng.choice([None, "a", "b", "c", "d"]), " ".join(rng.choices(["x", "Y", "é1", "z"], k=rng.randint(0, 4)))) for _ in range(120)] + [("e", None)]
    text_index.build(spark.createDataFrame(docs, "id string, text string"), str(tmp_path), "id", "text", segment=9)
    expected = Counter()
    for i, t in docs:
        for w in (t or "").lower().split():
            expected[w, i, len(t.split())] += 1
    rows = text_index.postings(spark, str(tmp_path), ["x", "y", "é1", "z"]).collect()
    assert {(r.term, p.d, p.len): p.tf for r in rows for p in r.docs} == dict(expected) and sum(len(r.docs) for r in rows) == len(expected)
    assert all(r.n == len(r.docs) and r.most == max(p.tf for p in r.docs) and r.least == min(p.len for p in r.docs) for r in rows)
    assert len({(r.term, r.segment) for r in rows}) == len(rows)
