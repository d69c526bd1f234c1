import random

import numpy as np
import pytest

from tidemark.llm import simhash_wide as wide


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def groups_of(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) * 5 >= 4 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def corpus(seed=3, many=40, variants=60):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(400)] + ["the", "of"] * 20
    say = lambda n: [rng.choice(vocab) for _ in range(n)]

    def vary(words, edits):
        words = list(words)
        for _ in range(edits):
            at, kind = rng.randrange(len(words)), rng.randrange(3)
            if kind == 0:
                words[at] = rng.choice(vocab)
            elif kind == 1:
                words.insert(at, rng.choice(vocab))
            elif len(words) > 1:
                del words[at]
        return words

    texts = []
    for _ in range(many):
        base = say(rng.choice([7, 20, 60, 200]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            texts.append(" ".join(vary(base, rng.randint(0, max(1, len(base) // 30)))))
    hot = say(150)  # a family without its origin: neighbours are like each other, others are not
    texts += [" ".join(vary(hot, rng.randint(1, 3))) for _ in range(variants)]
    chain = say(120)
    for _ in range(12):
        chain = chain[3:] + say(3)
        texts.append(" ".join(chain))
    texts += ["", None, " \n ", "one", "One", "two words", "a b c d e", "A  b c d E", " ".join(say(30_000))]
    return texts + texts[:4]


def check(spark, texts, **extra):
    docs = spark.createDataFrame([(1000 - i, t, i, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp int, node string")
    kept = {r.doc_id for r in wide.keep_first(docs, **extra).collect()}
    groups = groups_of(texts[::-1])  # ids go down
    expected = {1000 - (len(texts) - 1 - g) for g in set(groups)}
    return docs, kept, expected


@pytest.mark.parametrize("longest", [1024, 8])
def test_against_brute_force(spark, longest):
    texts = corpus(3 + longest)
    docs, kept, expected = check(spark, texts, longest=longest)
    # what a missed link leaves behind is a document too many, never one too few
    assert expected <= kept and len(kept - expected) <= 0.03 * (len(texts) - len(expected))
    assert wide.keep_first(docs.where("doc_id < 0")).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    threes, met = wide._threes(), 0
    for k in range(400):
        n = (12, 40, 200, 900)[k % 4]
        u = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
        shared = -(-8 * n // 9)  # of n shingles on either side: a similarity of 0.8
        a, b = (np.frombuffer(wide.fingerprint(np.unique(x)), np.uint8) for x in (u[:n], np.concatenate((u[:shared], u[n : 2 * n - shared]))))
        same = a == b
        met += same.sum() >= wide.MATCHES and any(same[list(t)].all() for t in threes)
    assert met >= 0.95 * 400


def test_null_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, long + " end"), (None, "something else entirely here now"), (7, long), (7, "another text of that id"), (7, long), (None, None), (3, ""), (None, "something else entirely here now")]
    docs = spark.createDataFrame([(*r, *range(10)) for r in rows], "doc_id long, text string, id int, t1 int, t2 int, row int, node int, stays int, none int, n int, _among int, f int")
    kept = wide.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(None, "something else entirely here now"), (7, long), (7, "another text of that id"), (3, "")], key=str)


def test_long_lists_lose_no_pair(spark):
    """Nodes of one list: all pairs meet in a tile but those within the largest group; tiles are small."""
    n = 60
    nodes = spark.createDataFrame([(bytes([i]), bytes(32)) for i in range(n)], "node binary, fp binary")
    whole = spark.createDataFrame([(key, bytes([i])) for key in (1, 2) for i in range(n)] + [(3, bytes([i])) for i in range(20)], "key long, node binary")
    parts = spark.createDataFrame([(bytes([i]), bytes([0 if i < 20 else 20])) for i in range(30)], "node binary, component binary")
    for known in (parts, None):
        held = {}
        for r in wide.tiles(whole, nodes, known, 16).collect():
            held.setdefault(r.key, []).append(r.node[0])
        assert max(map(len, held.values())) < n / 2 and all(len(set(x)) == len(x) for x in held.values())
        met = {(a, b) for x in held.values() for a in x for b in x if a < b}
        inside = {(a, b) for a in range(20) for b in range(a + 1, 20)} if known is not None else set()
        assert {(a, b) for a in range(n) for b in range(a + 1, n)} - inside <= met


def test_pairs_of_a_list_that_further_positions_part(spark):
    """Twelve shared bytes, but none where a long list is read on: such pairs were never compared."""
    rng = random.Random(5)
    first = set(random.Random(11).sample(range(wide.POSITIONS), wide.EXTRA))
    three = next(t for t in wide._threes() if not first & set(t))
    shared = set(sorted(set(range(wide.POSITIONS)) - first)[:12]) | set(three)
    prints = [bytes(7 if p in shared else rng.randrange(256) for p in range(wide.POSITIONS)) for _ in range(40)]
    nodes = spark.createDataFrame([(bytes([i]) * 16, fp) for i, fp in enumerate(prints)], "node binary, fp binary")
    short, whole = wide.lists(nodes, 8)
    met = {}
    for r in wide.tiles(whole, nodes, None, 8).collect():
        met.setdefault(r.key, set()).add(r.node[0])
    pairs = {(a, b) for x in met.values() for a in x for b in x if a < b}
    assert pairs == {(a, b) for a in range(40) for b in range(a + 1, 40)}
    before = {}
    for r in short.collect():
        before.setdefault(r.key, set()).add(r.node[0])
    assert not pairs <= {(a, b) for x in before.values() for a in x for b in x if a < b}
