import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import linededup


def brute(rows, num=4, den=5, least=5):
    lines = [(i, n, frozenset(w for w in line.lower().split() if w)) for i, t in rows if t is not None and i is not None for n, line in enumerate(t.split("\n"))]
    lines.sort(key=lambda x: x[:2])
    gone = {}
    for k, (i, n, s) in enumerate(lines):
        if len(s) >= least and any((j, m) < (i, n) and len(r) >= least and len(s & r) * den >= num * len(s | r) for j, m, r in lines[:k]):
            gone.setdefault(i, []).append(n)
    return gone


def corpus(seed, many=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "de"] * 6 + [f"w{i}" for i in range(150)] + ["É", "ñu"]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 18))] for _ in range(40)]

    def vary(words):
        words = list(words)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rng.shuffle(words)
        return " ".join(w.upper() if rng.random() < 0.2 else w for w in words)

    texts = ["\n".join(vary(rng.choice(base)) if rng.random() < 0.6 else " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))) for _ in range(many)]
    hot = [f"h{i}" for i in range(30)]
    for _ in range(40):  # one line in many variants
        words = list(hot)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(30)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    return [*texts, None, "", "\n\n", "a b c d", "a b c d", "A  b c\td e", "e d c b a", "x " * 20_000, " ".join(f"u{i}" for i in range(5000))] + texts[:5]


@pytest.mark.parametrize("few", [32, 3])
def test_against_brute_force(spark, few):
    texts = corpus(3 + few)
    order = list(range(len(texts)))
    random.Random(2).shuffle(order)
    rows = [(order[i], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    expected = brute(rows)
    assert len(expected) > 20
    got = {}
    for r in linededup.removed_lines(docs, few=few).collect():
        got.setdefault(r.id, []).append(r.line)
    assert {i: sorted(x) for i, x in got.items()} == expected


def test_clean_and_digest(spark):
    rows = [(2, "one two three four five\nKeep me\nlast", "a"), (1, "five four THREE two one\n", "b"), (3, None, "c"), (None, "one two three four five", "d"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    got = {r.doc_id: r for r in linededup.clean(docs).collect()}
    assert got[2].text == "Keep me\nlast" and got[2].gone == "a" and (got[2].n_lines, got[2].n_removed, got[2].removed) == (3, 1, [0])
    assert got[1].text == "five four THREE two one\n" and got[3].text is None and got[None].text.startswith("one") and got[4].text == ""
    got = {r.doc_id: tuple(r) for r in linededup.digest(docs).collect()}
    assert got[2] == (2, 3, 1, "0") and got[3] == (3, 0, 0, "") and got[4] == (4, 1, 0, "")
    assert linededup.clean(docs.where("doc_id > 9")).count() == 0
    assert linededup.clean(docs.withColumn("removed", F.lit(1))).columns == ["doc_id", "text", "gone", "n_lines", "n_removed", "removed"]


def test_keep_lines(spark):
    rows = [(1, "a b c d e\nx", 11), (2, "E d c b a\n\n", 11), (3, "e d c b A\nnew one", 17), (None, "a b c d e", 9), (4, None, 0), (3, "other text", 10), (5, "", 0)]
    docs = spark.createDataFrame([(*r, *range(8)) for r in rows], "doc_id long, text string, n_chars long, words int, n_removed int, removed int, n_lines int, words_removed int, id int, gone int, _kept int")
    kept = linededup.keep_lines(docs, chars_col="n_chars")
    assert kept.columns == docs.columns
    got = sorted((tuple(r)[:3] for r in kept.collect()), key=str)
    assert got == sorted([(1, "a b c d e\nx", 11), (3, "new one", 7), (None, "a b c d e", 9), (4, None, 0), (5, "", 0)], key=str)
    assert all(tuple(r)[3:] == tuple(range(8)) for r in kept.collect())
    assert linededup.keep_lines(docs.where("doc_id > 9")).count() == 0


@pytest.mark.parametrize("few", [32, 2])
def test_short_lines_go(spark, few):
    rows = list(enumerate([*corpus(11, 30), "Les.\nAll rights reserved.\na b c d e", "les.\n\n all  rights RESERVED.\nd c b a\na b c", "a b c d\nx y z\nx y"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows, least=1)
    assert any(len(set(rows[i][1].split("\n")[n].split())) < 4 for i, lines in expected.items() for n in lines)
    assert {r.doc_id: r.removed for r in linededup.clean(docs, few=few).collect() if r.removed} == expected
    assert {r.doc_id: r.removed_lines for r in linededup.digest(docs).collect() if r.n_removed} == {i: ",".join(map(str, x)) for i, x in expected.items()}


def test_oracle(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    got = sorted(tuple(r) for r in linededup.digest(spark.read.parquet(path)).collect())
    con = duckdb.connect()
    con.sql(f"create view documents as from '{path}'")
    assert got == sorted(con.sql(linededup.ORACLE).fetchall())


@pytest.mark.parametrize("few", [32, 2])
def test_keys_are_dealt_in_parts(spark, few, monkeypatch):
    """One part of the keys after the other loses no removal, nor do usual or frequent keys fall between the parts."""
    rows = list(enumerate(corpus(17, 30)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, kept = [], linededup.saved

    def watched(df):
        plan = df._jdf.queryExecution().analyzed().toString()
        if "pmod(key" in plan and "x_id" in df.columns:
            seen.append(plan)
        return kept(df)

    monkeypatch.setattr(linededup, "saved", watched)
    got = {}
    for r in linededup.removed_lines(docs, min_words=1, few=few).collect():
        got.setdefault(r.id, []).append(r.line)
    assert {i: sorted(x) for i, x in got.items()} == brute(rows, least=1)
    assert len(seen) >= linededup.PARTS > 1 and len(seen) % linededup.PARTS == 0
