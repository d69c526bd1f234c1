import random

import numpy as np
import pytest

from tidemark.llm import decontaminate as dc


def brute_distance(item, text):
    line = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(line[j] + (a != b), line[j + 1] + 1, new[j] + 1))
        line = new
    return min(line)


def corpus(seed=4):
    rng = random.Random(seed)
    vocab = ["the", "of", "and"] * 30 + [f"w{i}" for i in range(300)] + ["ñu", "É"]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [say(rng.randint(15, 50)) for _ in range(30)] + [say(5), say(3), say(8)]
    texts = []
    for k in range(150):
        item = list(rng.choice(items[:30]))
        for _ in range(rng.randint(0, dc.allowed(len(item)) + 3) if k % 3 else 0):
            at = rng.randrange(len(item))
            edit = rng.randrange(3)
            if edit == 0:
                item[at] = rng.choice(vocab)
            elif edit == 1:
                item.insert(at, rng.choice(vocab))
            elif len(item) > 1:
                del item[at]
        noise = "&&& " if k % 5 == 0 else " "
        texts.append(noise.join(say(rng.randint(0, 40)) + item + say(rng.randint(0, 40))).upper() if k % 7 == 0 else noise.join(say(9) + item))
    return items, [*texts, None, "", " ".join(say(20_000)), "x", " ".join(items[31]), "!!! " + " ".join(items[30])]


def test_distance():
    rng = random.Random(1)
    for _ in range(200):
        item, text = [[rng.randrange(4) for _ in range(rng.randrange(1, 9))] for _ in range(2)]
        assert dc.distance_to_stretch(item, text) == brute_distance(item, text)


def test_runs_are_guaranteed():
    for n in range(1, 200):
        e = dc.allowed(n)
        assert 1 <= dc.run_length(n) and (e + 1) * (dc.run_length(n) - 1) < n - e


def test_walk_is_deterministic_and_local():
    rows = np.array([[1, 2, 3, 4], [1, 2, 3, 4], [1, 9, 3, 4]])
    coins = np.random.default_rng(1).integers(1, 1 << 63, (8, 3), dtype=np.uint64) | np.uint64(1)
    out = np.stack(list(dc.cgk(rows, np.array([4, 4, 4]), coins)), axis=2)
    assert (out[0] == out[1]).all() and (out[:, :, 0] == 1).all() and (out[0] != out[2]).any()
    # unlike the other walks, a window shows its words in order
    for shown in out.reshape(9, 8):
        inside = shown[shown > 0]
        assert len(inside) and (np.diff([{1: 0, 2: 1, 9: 1, 3: 2, 4: 3}[x] for x in inside.tolist()]) >= 0).all()


@pytest.mark.parametrize("kind", dc.EDITS)
def test_recall_by_kind_of_edit(kind):
    """Every mutation at full tolerance, against the exact distance, which all of them are within."""
    rng = random.Random(len(kind))
    vocab = ["the", "of", "and"] * 30 + [f"w{i}" for i in range(2000)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([5, 9, 16, 24, 38, 61])))) for i in range(60)]
    index = dc.Index(items)
    texts, origin = [], []
    for k in range(240):
        words = dc.words_of(items[k % 60][1])
        changed = [f"new{-x}" if x < 0 else words[x - 1] for x in dc.mutated(list(range(1, len(words) + 1)), kind, rng)]
        texts.append(np.array([index.numbers.get(w, 0) for w in say(20) + changed + say(20)]))
        origin.append(k % 60)
    near = [k for k in range(240) if dc.distance_to_stretch(index.items[origin[k]], texts[k].tolist()) <= dc.allowed(len(index.items[origin[k]]))]
    got = index.search(texts)
    assert len(near) == 240 and sum(origin[k] in [i for i, _ in got[k]] for k in near) >= 0.96 * len(near)


def test_without_enough_tables(monkeypatch):
    """Too few tables: the length is searched exactly."""
    monkeypatch.setattr(dc, "MOST_TABLES", 2)
    items, _ = corpus()
    index = dc.Index([(i, " ".join(w)) for i, w in enumerate(items)])
    assert all(t.exact for n, t in index.tables.items() if dc.allowed(n) > 2)
    rng = random.Random(3)
    texts = [np.array([0, 0, *(max(0, x) for x in dc.mutated(item, "mixed", rng)), 0]) for item in index.items]
    assert all(index.ids[k] in [i for i, _ in found] for k, found in enumerate(index.search(texts)))


def test_against_brute_force(spark):
    items, texts = corpus()
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(items)] + [(90, None, "x"), (91, " ", "x")], "item_id long, text string, lang string")
    docs = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    expected = set()
    for d, t in enumerate(texts):
        words = dc.words_of(t)
        for i, item in enumerate(items):
            if words and len(words) < 5000 and brute_distance([w.lower() for w in item], words) <= dc.allowed(len(item)):
                expected.add((d, i))
    for block in (10, 20_000):
        got = {(r.doc_id, x.item) for r in dc.search(docs, bench, block=block).collect() for x in r.found if r.doc_id != 152}
        assert got <= expected and len(got) >= 0.97 * len(expected) > 80
    kept = {r.doc_id for r in dc.keep_clean(docs, bench).collect()}
    assert not (kept & {d for d, _ in got}) and len(kept) >= len(texts) - len({d for d, _ in expected}) - 2
    assert dc.search(docs, bench.where("item_id < 0")).where("size(found) > 0").count() == 0
    assert dc.search(docs.where("doc_id < 0"), bench).count() == 0
