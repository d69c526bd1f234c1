import hashlib
import random

import duckdb
import pytest

from tidemark.llm import substring


def brute(rows, window=50):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def corpus(seed=7):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["é", "ñandú"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [say(50), say(51), say(49), say(120)]
    texts = [None, "", " \n ", say(10), "the " * 200, "the " * 49, "a b " * 90]
    for _ in range(40):
        texts.append("\n".join([say(rng.randint(0, 40)), rng.choice(passages), say(rng.randint(0, 60)), rng.choice(passages), say(3)]))
    texts += texts[12:20] + [texts[9].replace(" ", "\t")] + [passages[3]] * 3 + [passages[0]] * 2
    near = texts[10].split()
    near[len(near) // 2] = "changed"
    return [*texts, " ".join(near), say(30_000), "the " * 5000]


@pytest.mark.parametrize("hot", [4096, 5])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    texts = corpus()
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(order[i], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sha string")
    expected = brute(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs).collect()}
    assert got == {i: x[:3] for i, x in expected.items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring.remove_repeats(docs, with_text=True).collect()}
    assert got == expected


def test_odd_rows(spark):
    text = " ".join(f"x{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (1, "short"), (None, text), (2, text + " y")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == [(-1, 60, 0), (1, 1, 0), (1, 60, 0), (1, 60, 0), (2, 61, 60)]
    assert substring.remove_repeats(docs.where("doc_id > 9")).count() == 0


def test_oracle(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    got = sorted(tuple(r) for r in substring.remove_repeats(spark.read.parquet(path)).collect())
    con = duckdb.connect()
    con.sql(f"create view documents as from '{path}'")
    assert got == sorted(con.sql(substring.ORACLE).fetchall())
