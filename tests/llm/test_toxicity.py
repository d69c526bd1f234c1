import binascii
import random

import numpy as np
import pytest

from tidemark.llm import toxicity as tox


def corpus(n=500, seed=3):
    rng = random.Random(seed)
    plain = ["the", "and", "with", "table", "water", "reading", "garden", "little", "morning", "paper", "window", "dialog", "diode", "stop"]
    bad = ["idiot", "moron", "stupid", "worthless"]
    disguise = {"idiot": ["1d10t", "i d i o t", "idiooot", "id!ot", "i.d.i.o.t", "!d1ot"], "moron": ["m0r0n", "m o r o n", "morrron"], "stupid": ["stup1d", "s-t-u-p-i-d", "$tupid"], "worthless": ["w0rthl3ss", "worthle$$"]}
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                b = rng.choice(bad)
                words.insert(rng.randrange(len(words)), rng.choice(disguise[b]) if i % 8 == 0 else b.upper() + "!!")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic) if i % 50 != 3 else 1 - int(toxic)))  # some labels are wrong
    return docs, labels


def arrays(counts):
    return np.array(sorted(counts), np.int64), np.array([counts[g] for g in sorted(counts)], np.int64)


def test_restores_disguised_words():
    counts = {}
    for word in ["idiot", "moron", "stupid", "the", "and", "window"] * 50:
        c = tox.codes(word)
        for g in ((c[:-2] * tox.SIZE + c[1:-1]) * tox.SIZE + c[2:]).tolist():
            counts[g] = counts.get(g, 0) + 1
    speller = tox.Speller(*arrays(counts))
    for token in ("1d10t", "id!ot", "idiooot", "i.d.i.o.t", "!d1ot", "i-d-i-0-t"):
        assert speller.decode(token).replace(" ", "") == "idiot", token
    assert speller.decode("m0r0n") == "moron" and speller.decode("$tup1d") == "stupid"
    assert "idiot" in tox.Reader(speller).restored("the i d i o t and")
    assert {"stupid", "idiot"} <= tox.Reader(speller).restored("s t u p i d i d i o t")
    assert tox.Reader(speller).restored("the window") == {"the", "window"}


def brute_decode(speller, token, spelled=False):
    """The least cost over every reading of the lattice."""
    best = [float("inf")]

    def go(at, a, b, last, cost, letters):
        if cost >= best[0]:
            return
        if at == len(token):
            total = cost + speller.cost(a, b, 0)
            if total < best[0]:
                best[:] = [total, letters.strip()]
            return
        ch = token[at]
        options = ([(ch, 0.0)] if ch.isalpha() else []) + [(x, tox.IMITATION) for x in tox.IMITATES.get(ch, "")]
        if ch in tox.SEPARATORS:
            go(at + 1, a, b, last, cost + tox.DELETION, letters)
            if b:
                go(at + 1, b, 0, "", cost + speller.cost(a, b, 0) + tox.BREAK, letters + " ")
            return
        if not options:
            go(at + 1, a, b, last, cost + 2 * tox.DELETION, letters)
            return
        if ch == last:
            go(at + 1, a, b, last, cost + tox.REPEAT, letters)
        if not ch.isalnum():
            go(at + 1, a, b, last, cost + tox.SIGN, letters)
        for letter, price in options:
            c = tox.CODE.get(letter, tox.OTHER)
            go(at + 1, b, c, ch, cost + price + speller.cost(a, b, c), letters + letter)
            if spelled and b:
                go(at + 1, 0, c, ch, cost + tox.BREAK + speller.cost(a, b, 0) + price + speller.cost(b, 0, c), letters + " " + letter)

    go(0, 0, 0, "", 0.0, "")
    return best


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_against_all_readings(seed):
    rng = random.Random(seed)
    counts = {}
    for word in ["idiot", "moron", "stupid", "the", "and", "scum", "ill", "lie", "base"] * 20:
        c = tox.codes(word)
        for g in ((c[:-2] * tox.SIZE + c[1:-1]) * tox.SIZE + c[2:]).tolist():
            counts[g] = counts.get(g, 0) + 1
    speller = tox.Speller(*arrays(counts))
    for _ in range(40):
        token = "".join(rng.choice("ids1!0o|l.-#t@ae") for _ in range(rng.randint(1, 8)))
        for spelled in (False, True):
            assert speller.decode(token, spelled) == brute_decode(speller, token, spelled)[1], (token, spelled)


def test_no_length_limits():
    counts = {}
    for word in ["idiot", "moron", "stupid", "the", "and", "window"] * 50:
        c = tox.codes(word)
        for g in ((c[:-2] * tox.SIZE + c[1:-1]) * tox.SIZE + c[2:]).tolist():
            counts[g] = counts.get(g, 0) + 1
    reader = tox.Reader(tox.Speller(*arrays(counts)))
    assert tox.trimmed("!d1ot") == "!d1ot" and tox.trimmed("(hello)") == "(hello" and tox.trimmed('"word"') == "word" and tox.trimmed("!!") == ""
    assert "idiot" in reader.restored("an !d1ot, really") and "the" in reader.restored("(the window)")
    assert "idiot" in reader.restored("1d1" + "-" * 60 + "ot")
    spelled = " ".join("the and " * 12).replace("   ", " ") + " i d i o t t h e"
    assert "idiot" in reader.restored(spelled)
    assert "idiot" in reader.restored("a1" * 30_000 + " 1d10t")


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in tox.score(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r.held_out == (binascii.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [i for i, r in got.items() if r.held_out]
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in held]) > 0.95
    kept = {r.doc_id for r in tox.keep_clean(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_odd_rows(spark):
    docs, labels = corpus(120)
    rows = [*docs, (1000, None), (1001, ""), (1002, "x" * 100_000), (1003, "a " * 50_000), (None, "idiot"), (5, docs[5][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (5, 0), (None, 1), (1000, 1), (1001, 7)], "doc_id long, toxic int")
    got = tox.score(d, lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = lab.where("doc_id < 0")
    assert {r.predicted for r in tox.score(d, none).collect()} == {0}
    assert tox.score(d.where("doc_id < 0"), lab).count() == 0
