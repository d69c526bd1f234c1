import math
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import quality as q

SCHEMA = "doc_id long, text string"


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    words = ["the", "river", "under", "stone", "walks", "with", "green", "letters", "and", "morning", "paper"]
    docs, labels = [], []
    for i in range(n):
        text = ". ".join(" ".join(rng.choice(words) for _ in range(7)).capitalize() for _ in range(rng.randint(2, 9))) + "."
        good = i % 5 != 0
        if not good:
            text = rng.choice([text.upper().replace(".", "!!"), " | ".join(text.split()), "Buy " * 40, "".join(c + "$$$ " if c == " " else c for c in text)])
        docs.append((i, text))
        labels.append((i, int(good) if i % 60 != 7 else 1 - int(good)))  # some labels are wrong
    return docs, labels


def brute_features(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    n, size = len(w), len(t)
    share = lambda a, b: a / b if b else 0.0
    x = [math.log1p(n), share(size, n), share(len(set(w)), n), share(sum(a == b for a, b in zip(w, w[1:])), n)]
    up, alpha = (lambda c: c.isupper()), (lambda c: c.isalpha())
    count = {
        "sentences": sum(c in ".!?" and (k + 1 == size or t[k + 1].isspace()) for k, c in enumerate(t)),
        "lines": t.count("\n"), "shouted": t.count("!"), "bars": t.count("|"),
        "capital_words": sum(len(r) > 1 and all(map(up, r)) for r in re.findall(r"[^\W\d_]+", t)),
        "sign_runs": len(re.findall(r"[^\w\s]{3,}", t)),
        "letterless": sum(not any(map(alpha, x)) for x in t.split()),
        "linked": len(re.findall(r"https?://|www\.", t)),
        "marked": sum(c in "<>{}[]\\=_#@$%&*^~+" for c in t),
    }
    x += [share(count[k], n) for k in q.BY_WORD]
    x += [share(sum(not alpha(c) for c in t), size), share(sum(map(up, t)), size), share(sum(c.isdigit() for c in t), size)]
    x = [min(v, 50.0) for v in x]
    return x + [math.log1p(100 * v) for v in x[2:]]


def test_features_equal_brute_force(spark):
    texts = [None, "", "  \n", "One two two. THREE!!", "a | b | c $$$ 12 34\nwww.x.org", "Ä ÖÜ! word word word", "x" * 100_000, "! " * 3000, "!" * 50_000, "Word " * 20_000]
    rows = q.features(spark.createDataFrame(list(enumerate(texts)), "i int, t string")).orderBy("i").collect()
    for text, row in zip(texts, rows):
        np.testing.assert_allclose(row.x, brute_features(text), err_msg=str(text)[:40])
        assert len(row.x) == len(q.ALL)


def test_fit_is_a_minimum_of_the_pairwise_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = (x @ [2, -1, 0] + rng.normal(size=60) > 0).astype(int)
    up, down = q.pairs(y)
    assert (y[up] == 1).all() and (y[down] == 0).all() and set(up) | set(down) == set(range(60))
    w = q.fit_pairs(x, up, down)

    def loss(w):
        total = 0.0
        for i, j in zip(up, down):
            total += math.log1p(math.exp(-float(w @ (x[i] - x[j]))))
        return total + q.PENALTY / 2 * float(w @ w)

    for k in range(3):
        for e in (-1e-3, 1e-3):
            assert loss(w) <= loss(w + e * np.eye(3)[k])


def test_best_quantile_separates():
    raw = np.arange(100.0)
    assert 0.19 < q.best_quantile(raw, (raw >= 20).astype(int)) < 0.21


def test_held_out_rows_and_threshold(spark):
    docs, labels = corpus()
    got = q.score(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) >= 0.97 * len(held)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]  # held-out labels change nothing
    again = q.score(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(flipped, "doc_id long, quality int")).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    kept = q.keep_good(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.predicted)


@pytest.mark.parametrize("labels, expected", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, None)], 0.0)])
def test_labels_of_one_kind(spark, labels, expected):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "x")], SCHEMA)
    got = q.score(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert [r.score for r in got] == [expected] * 3


def test_odd_rows(spark):
    docs, labels = corpus(120)
    odd = [(None, None, 1, 1), (3, "", 1, 1), (3, "other text of a repeated id.", 1, 1), (7, "word " * 300_000, 1, 1)]
    rows = spark.createDataFrame([(i, t, 0, 0) for i, t in docs] + odd, SCHEMA + ", x int, t int")
    more = labels + [(3, 0), (None, 1), (5, None), (9, 7)]
    got = q.score(rows, spark.createDataFrame(more, "doc_id long, quality int")).collect()
    assert len(got) == len(docs) + 4 and all(r.score == r.score for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert q.score(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0
    assert q.keep_good(rows, spark.createDataFrame(more, "doc_id long, quality int")).columns == rows.columns


def test_fit_takes_all_pairs_of_all_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x @ [2, -1, 0] + rng.normal(size=300) > 0.5).astype(int)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    each = q.PARTNERS * (1 / len(good) + 1 / len(bad))
    expected = q.fit_pairs(x, np.repeat(good, len(bad)), np.tile(bad, len(good)), q.PENALTY / each)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(y, x)], "y int, x array<double>").repartition(3)
    got = q.fit_all_pairs(rows, np.zeros(3), np.ones(3), (len(bad), len(good)))
    np.testing.assert_allclose(got, expected, atol=2e-3)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_are_exact(spark, n):
    values = np.round(np.random.default_rng(n).normal(size=n), 2)  # some are equal
    got = q.quantiles(spark.createDataFrame([(float(v),) for v in values], "raw double").repartition(3), q.QUANTILES)
    np.testing.assert_allclose(got, np.quantile(values, q.QUANTILES), atol=1e-12)


def test_more_labels_than_a_sample_held(spark):
    from pyspark.sql import functions as F

    y = (F.col("id") % 2).cast("int")
    rows = spark.range(30_000).select(F.col("id").alias("i"), F.xxhash64("id").alias("o"), F.array(*(F.lit(0.0) if k else y + F.rand(5) for k in range(len(q.ALL)))).alias("x"))
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), y.alias("quality"))
    seen = []
    kept = q.fit_all_pairs
    try:
        q.fit_all_pairs = lambda rows, mean, spread, n, *more: seen.append((rows.count(), sum(n))) or kept(rows, mean, spread, n, *more)
        q.train(rows, labels)
    finally:
        q.fit_all_pairs = kept
    usable = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(30_000))
    assert seen == [(usable, usable)] and usable > 20_000
